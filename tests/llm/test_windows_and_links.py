"""Token alignment, benchmark windows and periodic runs against brute force, with awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from beamwright.llm import align, bpe, decontam, periodic
from beamwright.llm.queries import QUERIES
from tests.llm.conftest import prose

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def key(row):
    return str(tuple(row))


# -- token alignment ---------------------------------------------------------------------------------------------------------------


def token_spans(texts):
    """Whole texts through both libraries: ids and their byte ends, or none where they do not spell the text."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    alphabet = {c: n for n, c in enumerate(bpe.byte_alphabet())}
    spell_a = {i: bytes(alphabet[c] for c in t) for t, i in a.get_vocab(with_added_tokens=False).items()}
    spell_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.vocab_size())]
    for t in texts:
        sides = [(a.encode(" " + t, add_special_tokens=False).ids, spell_a), (b.encode(t), spell_b)] if t else []
        if all(b"".join(spell[i] for i in ids) == (" " + t).encode() for ids, spell in sides):
            yield [(ids, np.cumsum([len(spell[i]) for i in ids])) for ids, spell in sides] or None
        else:
            yield None


def alignment_of(rows):
    """Brute force over (doc_id, text): the expected rows."""
    links, groups, sizes = [], [], []
    for spans in token_spans([t or "" for _, t in rows]):
        if spans is None:
            links.append([]), groups.append([]), sizes.append((0, 0))
            continue
        (ids_a, end_a), (ids_b, end_b) = spans
        sizes.append((len(ids_a), len(ids_b)))
        i = j = 0
        some, cut, of_a, of_b = [], [], [], []
        while i < len(ids_a) and j < len(ids_b):
            some.append((ids_a[i], ids_b[j]))
            stop_a, stop_b = end_a[i] <= end_b[j], end_b[j] <= end_a[i]
            if stop_a:
                of_a.append(ids_a[i])
                i += 1
            if stop_b:
                of_b.append(ids_b[j])
                j += 1
            if stop_a and stop_b:
                cut.append(",".join(map(str, of_a)) + "|" + ",".join(map(str, of_b)))
                of_a, of_b = [], []
        links.append(some), groups.append(cut)
    count = Counter(p for some in links for p in some)
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    out = []
    for (i, _), n, cut, some in zip(rows, sizes, groups, links):
        out.append((i, *n, len(cut), len(some), sum(count[p] == top[p[1]] for p in some), sum(count[p] for p in some), sha(";".join(cut)) if cut else ""))
    return out


@pytest.fixture(scope="module")
def odd_texts(spark):
    rng = random.Random(8)
    bits = ["a", " ", "  ", "\n", "été", "\U0001F600", "中文", "<s>", "<|endoftext|>", "x1", "'ll", "\x85", "\t", "the", " the", "\r\n", "<0x41>", "̈", "0", "ing", "!!"]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(1, 40)))) for i in range(300)]
    rows += [(400, "a▁b"), (401, " "), (402, "  "), (403, "a "), (404, "\n"), (405, "x" * 5000), (406, "same " * 3000), (407, "\u0000")]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)


def test_alignment_matches_brute_force(awkward, odd_texts, nothing):
    docs = awkward.select("doc_id", "text").union(odd_texts)
    rows = [tuple(r) for r in docs.collect()]
    got = align.align(docs.withColumn("pairs", F.lit(1)).withColumn("block", F.lit("x")), A_PATH, B_PATH)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(key, got.collect())) == sorted(map(str, alignment_of(rows)))
    assert align.align(nothing, A_PATH, B_PATH).count() == 0
    nulls = awkward.select(F.lit(None).cast("bigint").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    assert {tuple(r) for r in align.align(nulls, A_PATH, B_PATH).collect()} == {(None, 0, 0, 0, 0, 0, 0, "")}


def test_alignment_over_many_blocks(monkeypatch, spark, odd_texts):
    """Small blocks, one partition: the same rows, and groups as text when asked for."""
    monkeypatch.setattr(align, "LINKS", 200)
    monkeypatch.setattr(align, "RUN", 100)
    rows = [tuple(r) for r in odd_texts.collect()]
    got = align.align(odd_texts.coalesce(1), A_PATH, B_PATH, groups=True)
    assert sorted(map(key, got.drop("groups").collect())) == sorted(map(str, alignment_of(rows)))
    assert all(r.groups_sha256 == (sha(r.groups) if r.groups else "") for r in got.collect())


def test_pair_counts(awkward):
    index = align.index_rows(awkward, A_PATH, B_PATH)
    want_docs, want_links = Counter(), Counter()
    for spans in token_spans([r.text or "" for r in awkward.collect()]):
        if spans:
            (ids_a, end_a), (ids_b, end_b) = spans
            at = np.union1d(end_a, end_b)
            some = Counter(zip(np.array(ids_a)[np.searchsorted(end_a, at)].tolist(), np.array(ids_b)[np.searchsorted(end_b, at)].tolist()))
            want_links.update(some)
            want_docs.update(some.keys())
    got = align.pair_counts(index).collect()
    assert {divmod(r.pair, 32000): (r.docs, r.links) for r in got} == {p: (want_docs[p], n) for p, n in want_links.items()}


def test_gap_bitmaps_round_trip():
    rng = np.random.default_rng(2)
    for _ in range(20):
        sets = [np.unique(rng.integers(0, rng.choice([300, 65535]), rng.integers(0, 50))) for _ in range(30)]
        sizes = np.array([len(s) for s in sets])
        flat = np.concatenate(sets).astype(np.int64)
        firsts = (np.cumsum(sizes) - sizes)[sizes > 0]
        number, bit = align.from_gaps(align.to_gaps(flat, firsts), sizes)
        assert (bit == flat).all() and (number == np.repeat(np.arange(30), sizes)).all()


# -- benchmark windows -----------------------------------------------------------------------------------------------------------


def low(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def hit_words(text, items, size):
    words, covered, held = low(text), set(), set()
    for item, t in items:
        w = low(t)
        n = min(size, len(w))
        windows = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in windows:
                covered |= set(range(i, i + n))
                held.add(item)
    return words, covered, held


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(3)
    long = prose(rng, 40)
    rows = [(1, long), (1, long.upper()), (2, " ".join(long.split()[20:]) + " own ending of this item here"), (10, "Two Words!"), (3, "---"), (4, None), (5, ""), (6, "x"),
            (None, "a line to share"), (None, None), (7, "same " * 12), (8, "ÉTÉ été"), (9, "12 3")]
    return spark.createDataFrame(rows, "item_id bigint, text string"), long


@pytest.fixture(scope="module")
def leaky(awkward, items):
    long = items[1].split()
    more = [(500, " ".join(long)), (501, "before, " + "; ".join(long[5:16]) + ". after"), (502, " ".join(long[3:12])), (503, " ".join(long[:10]).title()),
            (503, "x " * 200 + " ".join(long[:30]) + " x" * 70), (None, " ".join(long[:10]) + "?"), (504, "été ÉTÉ"), (505, "two, words -- TWO  words")]
    return awkward.select("doc_id", "text").union(awkward.sparkSession.createDataFrame(more, "doc_id bigint, text string"))


@pytest.mark.parametrize("at_once", [1 << 18, 7])
def test_benchmark_windows(monkeypatch, leaky, items, nothing, at_once):
    monkeypatch.setattr(decontam, "WINDOWS_AT_ONCE", at_once)
    pairs = [tuple(r) for r in items[0].collect()]
    want = []
    for r in leaky.collect():
        words, covered, held = hit_words(r.text, pairs, 10)
        ids = sorted(str(i) for i in held if i is not None)
        want.append((r.doc_id, len(words), len(covered), len(held), ids, bool(covered)))
    clash = leaky.withColumn("window", F.lit(1)).withColumn("held", F.lit(2)).withColumn("h", F.lit(3))
    got = decontam.marked(clash, items[0].withColumn("w", F.lit(1)))
    assert sorted(map(key, got.collect())) == sorted(map(str, want))
    assert sum(w[-1] for w in want) > 8
    assert decontam.marked(nothing, items[0]).count() == 0
    clean = decontam.marked(leaky, items[0].filter("false"))
    assert clean.count() == len(want) and not clean.filter("contaminated or n_hit > 0 or n_items > 0").count()


def test_benchmark_passages_removed(leaky, items, nothing):
    pairs = [tuple(r) for r in items[0].collect()]
    want_spans, want_docs = [], []
    for r in leaky.collect():
        words, covered, _ = hit_words(r.text, pairs, 10)
        if not covered:
            want_docs.append((r.doc_id, r.text, "kept"))
            want_spans.append(want_docs[-1])
            continue
        pieces = re.findall(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r.text)
        assert len(pieces) == len(words)
        rest = r.text[len("".join(pieces)) :]
        want_spans.append((r.doc_id, "".join(p for i, p in enumerate(pieces) if i not in covered) + rest, "kept"))
    docs = leaky.withColumn("marks", F.lit("kept"))
    assert sorted(map(key, decontam.removed(docs, items[0]).collect())) == sorted(map(str, want_spans))
    assert sorted(map(key, decontam.removed(docs, items[0], "documents").collect())) == sorted(map(str, want_docs))
    assert decontam.removed(nothing, items[0]).count() == 0 and decontam.removed(nothing, items[0]).columns == nothing.columns
    with pytest.raises(ValueError):
        decontam.removed(docs, items[0], "words")


def test_benchmark_windows_stay_native(leaky, items):
    plan = decontam.marked(leaky, items[0])._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInArrow" not in plan and "Cartesian" not in plan


def test_texts_are_cut_into_words_once(monkeypatch, leaky, items):
    """One scan of the documents gives hits and numbers of words; no filter beside it takes the words again."""
    windows = decontam.written(decontam.item_windows(items[0], 10), "item-windows")
    seen = decontam.scanned(leaky, windows)
    docs = seen.filter("pos < 0")
    assert sorted(r.length for r in docs.collect()) == sorted(len(low(r.text)) for r in leaky.collect())
    assert sorted(map(key, seen.filter("pos >= 0").collect())) == sorted(map(key, decontam.hits(leaky, windows).collect()))
    plan = decontam.scanned(decontam.written(leaky, "leaky"), windows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    cut, words = [], decontam.words
    monkeypatch.setattr(decontam, "words", lambda text: cut.append(text) or words(text))
    decontam.marked(leaky, items[0])
    assert len(cut) == 2  # of the items and of the documents


def test_words_hold_what_is_no_separator(spark):
    every = [chr(c) for c in [*range(1, 0x2100), 0xD7FF, 0xE000, 0xFFFD, 0x10000, 0x1F600, 0x10FFFF]]
    text = "".join(f"a{c}b " for c in every)
    assert spark.createDataFrame([(text,)], "t string").select(decontam.words(F.col("t"))).first()[0] == low(text)


# -- periodic runs ---------------------------------------------------------------------------------------------------------------


def all_runs(words, least=4, shortest=6):
    """Every maximal stretch with its smallest period, tried period by period."""
    found = {}
    for q in range(1, len(words) // least + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(shortest, least * q):
                found.setdefault((start, length), q)  # smaller periods come first
    return sorted((s, n, q) for (s, n), q in found.items())


def test_runs_match_every_period_tried():
    rng = random.Random(11)
    for case in range(400):
        alphabet = "abcdefgh"[: rng.choice([1, 2, 2, 3, 8])]
        parts = []
        for _ in range(rng.randint(1, 4)):
            root = rng.choices(alphabet, k=rng.randint(1, rng.choice([2, 9, 40])))
            parts += (root * 12)[: rng.randint(1, 7 * len(root))]
        words = [w.encode() for w in parts]
        least = rng.choice([3, 4, 4])
        (got, kept), (other, _) = periodic._batch([b" ".join(words), b"a a a a a a a"], least, 6)
        want = all_runs(words, least)
        assert got == sorted(want, key=lambda r: (r[0], r[2])), case
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert kept == b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert other == [(0, 7, 1)]


def test_periodic_runs_on_awkward_rows(awkward, nothing):
    rows = periodic.periodic_runs(awkward.repartition(2)).collect()
    assert len(rows) == awkward.count()
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", r.doc.text or "")
        if len(words) > 5000:
            continue
        want = all_runs(words)
        assert [tuple(x) for x in r.runs] == sorted(want, key=lambda x: (x[0], x[2]))
        gone = {i for s, n, q in want for i in range(s + q, s + n)}
        assert r.collapsed == " ".join(w for i, w in enumerate(words) if i not in gone)
    assert next(r.collapsed for r in rows if r.doc.doc_id == 14) == "same"
    assert periodic.periodic_runs(nothing).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(nothing, least=2)


def test_periodic_query(spark, tmp_path):
    """The query's own repetitions and digests, from documents with nulls, against brute force."""
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(0, 60))) for i in range(400)] + [(None, "a b " * 9), (401, None), (402, " \n"), (None, None), (403, "x y\x1cz " * 6)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want, planted = [], 0
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if i is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
            planted += 1
        runs = sorted(all_runs(words), key=lambda r: (r[0], r[2]))
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        gone = {k for s, m, q in runs for k in range(s + q, s + m)}
        want.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
                     sha(" ".join(w for k, w in enumerate(words) if k not in gone))))
    got = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert planted > 20 and sorted(map(key, got.collect())) == sorted(map(str, want))
