"""Per-record quality checks and scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorflow.functions.basic import all_of, as_col, band, count_true, present, within
from sensorflow.schema import DEVICE_RANGE, GATE_RANGE, MEASURES, MOTORS, RANGES, REQUIRED, SENSORS


def missing_fields(fields=REQUIRED, prefix: str = "") -> Column:
    return present(*(F.when(F.col(f).isNull(), F.lit(prefix + f)) for f in fields))


def passes_gate(fields=REQUIRED) -> Column:
    checks = [F.col(f).isNotNull() for f in fields] + [within(s, GATE_RANGE) for s in SENSORS]
    return F.coalesce(all_of(checks), F.lit(False))


def range_issues(fields=REQUIRED) -> Column:
    """Text list: missing fields first, then each value outside its range with the range it should be in."""
    missing = [F.when(F.col(f).isNull(), F.lit(f"Missing field: {f}")) for f in fields]
    ranged = [
        F.when(
            ~within(f, bounds),
            F.concat(F.lit(f"{f} out of range: "), F.col(f).cast("string"),
                     F.lit(f" (expected {bounds[0]}-{bounds[1]})")),
        )
        for f, bounds in {**RANGES, "DeviceId": DEVICE_RANGE}.items()
    ]
    return present(*missing, *ranged)


def validity_flags(fields=("DeviceId",) + MEASURES) -> dict[str, Column]:
    """One flag per ranged field; NULL is valid here because completeness accounts for it."""
    bounds = {**RANGES, "DeviceId": DEVICE_RANGE}
    return {f"{f}_range_valid": F.col(f).isNull() | within(f, bounds[f]) for f in fields}


def is_valid_record() -> Column:
    return all_of(validity_flags().values())


def record_quality(fields=REQUIRED) -> Column:
    """Struct of score, number of checks, passed checks, issues and grade. A range is checked only for a value
    that is there, so the number of checks varies from record to record."""
    here = [F.col(f).isNotNull() for f in fields]
    ranged = [F.col(f).isNotNull() for f in MEASURES]
    good = [within(f, RANGES[f]) for f in MEASURES]
    total = F.lit(len(here)) + count_true(ranged)
    passed = count_true(here) + count_true(good)
    score = passed / total
    issues = present(
        *(F.when(F.col(f).isNull(), F.lit(f"missing_{f}")) for f in fields),
        *(F.when(~within(f, RANGES[f]), F.lit(f"invalid_{f}_range")) for f in MEASURES),
    )
    return F.struct(
        score.alias("quality_score"), total.alias("total_checks"), passed.alias("passed_checks"),
        issues.alias("issues"),
        band(score, [(0.7, "FAIR"), (0.85, "GOOD"), (0.95, "EXCELLENT")], "POOR").alias("grade"),
    )


def range_score() -> Column:
    return F.when(all_of(within(s, RANGES[s]) for s in SENSORS), 1.0).otherwise(0.0)


def presence_score(fields=MEASURES) -> Column:
    return count_true(F.col(f).isNotNull() for f in fields) / F.lit(float(len(fields)))


def nested_score(temperature, humidity, vibration) -> Column:
    """Share of three tests: temperature present, humidity within 20-90, vibration above zero."""
    tests = (as_col(temperature).isNotNull(), within(humidity, (20, 90)), as_col(vibration) > 0)
    return count_true(tests) / 3.0


# Kinds of JSON values as `schema_of_variant` names them; decimals are how it reads numbers with a fraction.
_INTEGER = "^(BIGINT|INT|SMALLINT|TINYINT)$"
_NUMBER = "^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"
_BOOLEAN = "^BOOLEAN$"


def type_errors(payload: Column | str) -> Column:
    """Fields of a JSON text whose value is of the wrong kind. Text that is no JSON object has every error."""
    parsed = F.try_parse_json(as_col(payload))
    rules = {"DeviceId": (_INTEGER, "integer"), "isFail": (_BOOLEAN, "boolean")}
    rules |= {s: (_NUMBER, "number") for s in SENSORS}
    rules |= {m: (_INTEGER, "integer") for m in MOTORS}
    checks = []
    for field, (pattern, kind) in rules.items():
        found = F.schema_of_variant(F.try_variant_get(parsed, f"$.{field}", "variant"))
        fits = F.coalesce(found.rlike(pattern), F.lit(False))
        checks.append(F.when(~fits, F.lit(f"{field} must be {kind}")))
    return present(*checks)
