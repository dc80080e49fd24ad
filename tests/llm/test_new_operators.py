"""Value dictionaries, source divergence and the piece codec against plain versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from sensorflow.llm import piece_codec, source_divergence, tasks, value_dictionaries

# --- pieces -----------------------------------------------------------------------------------------------------------

ODD = [
    (1, "Hello  wörld\n漢① x"), (2, None), (3, ""), (4, "   \n\t "), (5, "▁a▁ b<s></s><0x0A><unk>"), (6, "x" * 40_000),
    (7, "word " * 20_000), (8, "same"), (8, "same"), (None, "no id"), (None, None), (9, "\0a　b‍😀é \r\n "),
]


@pytest.fixture(scope="module")
def docs(spark):
    tasks.prepare(spark)
    return spark.createDataFrame([(i, t, 5, "clash") for i, t in ODD], "doc_id long, text string, ids int, decoded string")


@pytest.fixture(scope="module")
def coder():
    return piece_codec.model(piece_codec.default_path())


def plain_pieces(library, text):
    found = library.encode(text, return_type="proto").pieces
    return [p.id for p in found], [(p.begin, p.end) for p in found]


def random_texts(letters, number, length):
    pick = random.Random(7)
    return ["".join(pick.choice(letters) for _ in range(pick.randint(0, length))) for _ in range(number)]


def test_pieces_and_spans_as_the_library(coder):
    for text in random_texts(" ab\n\t▁é漢①ﬁ<0x>the ing 😀\0　er", 3000, 30):
        found = coder.encode(text)
        assert (found.ids.tolist(), list(zip(found.begins.tolist(), found.ends.tolist(), strict=True))) == plain_pieces(coder.library, text), text


def test_texts_of_the_table(spark, small, coder):
    for row in spark.read.parquet(f"{small}/documents.parquet").select("text").collect():
        assert coder.encode(row.text, True, True).ids.tolist() == coder.library.encode(row.text, add_bos=True, add_eos=True)


@pytest.mark.parametrize("prefix", [False, True])
@pytest.mark.parametrize("squeeze", [False, True])
def test_longest_prefixes_of_a_compiled_map(prefix, squeeze):
    """A map with compositions, ligatures and removed characters, which the library carries itself."""
    plain = sentencepiece.SentencePieceNormalizer(
        rule_name="nmt_nfkc", add_dummy_prefix=prefix, escape_whitespaces=False, remove_extra_whitespaces=squeeze)
    proto = sentencepiece_model_pb2.ModelProto.FromString(plain.serialized_model_proto())
    own = piece_codec.Normalizer(piece_codec.CharacterMap(proto.normalizer_spec.precompiled_charsmap), prefix, squeeze, False)
    for text in random_texts("  ab̀\n\t①ﬁé漢　Ｈｶﾞ😀‍\x01", 3000, 12):
        wanted, places = plain.normalize(text, with_offsets=True)
        found, source = own.normalize(text)
        data = text.encode()
        assert (found, [len(data[:i].decode()) for i in source.tolist()]) == (wanted, list(places)), repr(text)


def test_encode_documents(docs, coder):
    rows = piece_codec.encode_documents(docs, digests=True).collect()
    wanted = []
    for i, text in ODD:
        ids = coder.library.encode(text or "", add_bos=True, add_eos=True)
        wanted.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256(coder.library.decode(ids).encode()).hexdigest(), *[len((text or "").encode())] * 2))
    assert sorted(map(tuple, rows), key=str) == sorted(wanted, key=str)
    whole = piece_codec.encode_documents(docs, bos=False, eos=False)
    for row in whole.filter("doc_id IN (1, 5, 7)").collect():
        text = dict(ODD)[row.doc_id].encode()
        assert b"".join(text[a:b] for a, b in zip(row.begins, row.ends, strict=True)) == text
    assert piece_codec.encode_documents(docs.filter("false")).count() == 0


def test_a_unit_of_a_million_characters(coder):
    for text in ("ab" * 500_000, "漢字" * 100_000):
        assert coder.encode(text).ids.tolist() == coder.library.encode(text)


def test_other_models_are_refused(tmp_path, coder):
    proto = sentencepiece_model_pb2.ModelProto.FromString(coder.library.serialized_model_proto())
    proto.trainer_spec.model_type = 1
    (tmp_path / "m").write_bytes(proto.SerializeToString())
    with pytest.raises(ValueError, match="byte-pair"):
        piece_codec.Model(str(tmp_path / "m"))


# --- value dictionaries -----------------------------------------------------------------------------------------------

def plain_codes(rows, entries, rounds=4, scale=1024):
    """Every distance by a loop over components. Rows are (vec_id, integers, label) of one length, in order of vec_id."""
    length = len(rows[0][1])
    cuts = value_dictionaries.slices(length)
    books = [[list(v[c]) for _, v, _ in rows[:entries]] for c in cuts]

    def near(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e, strict=True)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for c, book in zip(cuts, books, strict=True):
            members = defaultdict(list)
            for _, v, _ in rows:
                members[near(v[c], book)[1]].append(v[c])
            for i, parts in members.items():
                book[i] = [sum(xs) // len(xs) for xs in zip(*parts, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [(i, [near(v[c], b) for c, b in zip(cuts, books, strict=True)], label) for i, v, label in rows]
    return [(i, "".join(f"{e:02x}" for _, e in f), sum(d for d, _ in f), label, digest) for i, f, label in found]


def coded(spark, rows, **how):
    tasks.prepare(spark)
    table = spark.createDataFrame([(*r, "clash", 3) for r in rows], "vec_id long, embedding array<double>, label int, code string, salt int")
    return sorted(map(tuple, value_dictionaries.encode(table, **how).collect()), key=str)


def wanted_codes(rows, entries=256):
    kept = sorted(((i, [int(x * 1024 // 1) for x in v], label) for i, v, label in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    made = [r for n in sorted({len(v) for _, v, _ in kept}) for r in plain_codes([k for k in kept if len(k[1]) == n], entries)]
    sums = Counter()
    for _, _, error, label, _ in made:
        sums[label] += error
    return sorted(((i, code, error, sums[label], digest) for i, code, error, label, digest in made), key=str)


@pytest.mark.parametrize("entries", [5, 256])
def test_codes_by_brute_force(spark, entries):
    pick = random.Random(3)
    rows = [(i, [pick.gauss(0, 0.3) for _ in range(8)], pick.choice([None, 1, 2])) for i in range(60)]
    rows += [(5, rows[5][1], 1), (70, rows[9][1], None), (None, rows[3][1], 2), (None, rows[2][1], 2)]  # ties and repeated rows
    rows += [(80 + i, [pick.gauss(0, 0.3) for _ in range(7)], 9) for i in range(6)]  # another length, no multiple of four
    odd = [(90, None, 1), (91, [float("nan")] * 8, 1), (92, [None] + [0.1] * 7, 1), (93, [float("-inf")] * 8, 2)]
    assert coded(spark, rows + odd, entries=entries) == wanted_codes(rows, entries)


def test_codes_of_few_and_of_large_vectors(spark):
    assert coded(spark, []) == [] and coded(spark, [(1, None, None)]) == []
    assert coded(spark, [(1, [0.5, -0.5], 1)]) == wanted_codes([(1, [0.5, -0.5], 1)])
    assert [r[1:4] for r in coded(spark, [(1, [], 1), (2, [], None)])] == [("00000000", 0, 0)] * 2
    huge = coded(spark, [(1, [1e308, -1e308, 0.0, 1.0], 1), (2, [3.0, 1e30, 0.0, 1.0], 1)], entries=1)
    assert len(huge) == 2 and all(r[2] > 0 for r in huge)  # clipped, not wrapped


def test_dictionary_distances():
    block = np.array([[1, -3], [1, 9], [4, -3]])
    book = np.array([[0, 0], [4, -3], [4, -3]])
    index, error = value_dictionaries.nearest(block, book)
    assert (index.tolist(), error.tolist()) == ([1, 0, 1], [9, 82, 0])
    wide = value_dictionaries.nearest(block << 24, book << 24)
    assert wide[1].tolist() == [9 << 48, 82 << 48, 0]


# --- sources ----------------------------------------------------------------------------------------------------------

def plain_audit(rows, least, top=10):
    docs = [(lang or "", source or "", Counter(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))))
            for text, lang, source in rows]
    found = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for d in own for t in d[2])
        kept = sorted(t for t, n in seen.items() if n >= least)
        sums = {s: Counter() for s in {d[1] for d in own}}
        for _, source, words in own:
            sums[source].update({t: n for t, n in words.items() if t in kept})
        whole = sum(sums.values(), Counter())

        def shares(counts):
            return [1 + 10**9 * (counts[t] + 2) // (sum(counts.values()) + 2 * len(kept)) for t in kept]  # noqa: B023

        def apart(a, b):
            return [(p - q) ** 2 // (p + q) for p, q in zip(a, b, strict=True)]

        p, q = {s: shares(c) for s, c in sums.items()}, shares(whole)
        for s in sums:
            pairs = sorted((-sum(apart(p[s], p[o])), o.encode(), o) for o in sums if o != s)
            found += [(lang, s, "pair", o, -v, i) for i, (v, _, o) in enumerate(pairs, 1)]
            terms = sorted((-f, t.encode(), t) for t, f, a, b in zip(kept, apart(p[s], q), p[s], q, strict=True) if sums[s][t] and a > b)
            found += [(lang, s, "term", t, -v, i) for i, (v, _, t) in enumerate(terms[:top], 1)]
    return sorted(found)


def audited(spark, rows, **how):
    tasks.prepare(spark)
    table = spark.createDataFrame([(*r, 1, "clash", 2) for r in rows], "text string, lang string, source string, rank int, term string, block int")
    return sorted(map(tuple, source_divergence.audit(table, **how).collect()))


@pytest.fixture(scope="module")
def many():
    pick = random.Random(5)
    words = ["alpha", "Beta", "gamma", "ÉTÉ", "été", "漢字", "x", "delta", "eps", "zeta"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(" ".join(pick.choices(words, range(1, len(words) + 1), k=pick.randint(0, 12))), pick.choice(["en", "de"]), pick.choice("abcdefg")) for _ in range(120)]
    rows += [(None, "en", "a"), ("alpha alpha", None, None), ("alpha alpha", None, "s"), ("alpha", "", ""), ("", "xx", "only"), (None, "yy", "p"), ("rare", "yy", "q"),
             ("1234 !!", "en", "nothing"), ("beta\0beta", "en", "a")]
    return rows + [("same words here", "en", "g")] * 12


@pytest.mark.parametrize("how", [{}, {"terms_in_block": 4, "groups_in_block": 3, "terms_at_once": 5}])
def test_audit_by_brute_force(spark, many, how):
    assert audited(spark, many, min_documents=3, **how) == plain_audit(many, 3)


def test_audit_without_terms_or_rows(spark):
    assert audited(spark, []) == []
    rows = [("a b", "en", "s"), (None, None, "t"), ("", None, "u")]
    assert audited(spark, rows) == plain_audit(rows, 10) == [("", "t", "pair", "u", 0, 1), ("", "u", "pair", "t", 0, 1)]


def test_large_counts_keep_every_digit(spark):
    rows = spark.createDataFrame([(3_000_000_000_000, 4_000_000_000_000, 5)], "c long, n long, v long")
    share = rows.select(source_divergence._share(rows.c, rows.n, rows.v)).first()[0]
    assert share == 1 + 10**9 * 3_000_000_000_002 // 4_000_000_000_010
