"""Operators on documents against brute force, with awkward rows."""

import hashlib
import re
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from beamwright.llm import bpe, jaccard, lines, mixing, spotsigs, tokencount

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ENGLISH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def bag(df):
    return Counter(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.collect())


def tiktoken_of(path):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_bpe_digests(awkward, nothing):
    enc = tiktoken_of(MULTI)
    want = Counter()
    for i, t in texts(awkward):
        ids = enc.encode_ordinary(t or "")
        want[(i, len(ids), sha(",".join(map(str, ids))), sha(t or ""))] += 1
    assert bag(bpe.digests(awkward, MULTI, PATTERN)) == want
    assert bpe.digests(nothing, MULTI, PATTERN).count() == 0


def test_bpe_round_trip_and_offsets(awkward):
    rows = bpe.decode(bpe.encode(awkward, MULTI, PATTERN), MULTI, PATTERN).collect()
    together = bpe.encode(awkward, MULTI, PATTERN, decoded=True)
    assert Counter(map(str, together.select("doc.doc_id", "decoded").collect())) == Counter(str(r) for r in awkward.selectExpr("doc_id", "coalesce(text, '') AS decoded").collect())
    enc = tiktoken_of(MULTI)
    for r in rows:
        text = r.doc.text or ""
        assert r.decoded == text
        if len(text) < 5000:
            assert r.ids == enc.encode_ordinary(text)
            character = [i for i, c in enumerate(text) for _ in c.encode()]
            at = 0
            for token, start in zip(r.ids, r.starts):
                assert start == character[at]
                at += len(enc.decode_single_token_bytes(token))


def test_token_counts_after_edits(awkward, nothing):
    enc = tiktoken_of(ENGLISH)
    changes = [(3, 9, "put in"), (-4, 2, None), (40, 10_000, " tail's"), (20, 20, "\n \n"), (0, 0, "'s")]
    edits = F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(c).cast("string").alias("replacement")) for a, b, c in changes])
    docs = awkward.withColumn("edits", edits)
    for r in tokencount.recount(docs, ENGLISH, PATTERN).collect():
        text = r.doc.text or ""
        assert r.n_tokens == len(enc.encode_ordinary(text))
        for a, b, c in changes:
            a = min(max(a, 0), len(text))
            b = min(max(b, a), len(text))
            text = text[:a] + (c or "") + text[b:]
        assert (r.edited_text, r.n_tokens_edited, r.edited_sha256) == (text, len(enc.encode_ordinary(text)), sha(text))
        assert sum(r.segment_tokens) == r.n_tokens_edited
    assert tokencount.recount(nothing.withColumn("edits", edits), ENGLISH, PATTERN).count() == 0


def test_stored_trees_take_edits(awkward, nothing):
    """Two rounds of edits on a stored table against whole counts; unedited documents keep their row; nothing but the edits is encoded."""
    enc = tiktoken_of(ENGLISH)
    change = "array(named_struct('start', {}, 'end', {}, 'replacement', {}))"
    first = F.expr(f"case when doc.n % 3 = 0 then {change.format(3, 9, chr(39) + 'put in' + chr(39))} when doc.n % 3 = 1 then {change.format(0, 0, 'cast(null as string)')} end")
    second = F.expr(f"case when doc.n % 2 = 0 then {change.format(1, 4, chr(39) + ' x' + chr(39))} end")
    docs = awkward.select("text", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("n"), F.lit(1).alias("n_tokens"), F.lit(2).alias("segment_chars"))
    start = tokencount.stored(docs, ENGLISH, PATTERN)
    once = tokencount.apply_edits(start, first, ENGLISH, PATTERN)
    twice = tokencount.apply_edits(once, second, ENGLISH, PATTERN)

    def after(text, low, high, put):
        low = min(low, len(text))
        high = min(max(high, low), len(text))
        return text[:low] + put + text[high:]

    want = Counter()
    for r in docs.collect():
        t = r.text or ""
        one = after(t, 3, 9, "put in") if r.n % 3 == 0 else t
        two = after(one, 1, 4, " x") if r.n % 2 == 0 else one
        want[(r.n, two, len(enc.encode_ordinary(one)), len(enc.encode_ordinary(two)))] += 1
    rows = twice.collect()
    assert Counter((r.doc.n, r.text, r.n_tokens_before, r.n_tokens) for r in rows) == want
    for r in rows:
        assert sum(r.segment_tokens) == r.n_tokens and sum(r.segment_chars) == len(r.text)
        assert r.doc.n % 2 == 0 or r.n_chars_reencoded == 0
    assert tokencount.apply_edits(tokencount.stored(nothing, ENGLISH, PATTERN), F.lit(None).cast("array<struct<start:int,end:int,replacement:string>>"), ENGLISH, PATTERN).count() == 0
    assert tokencount.stored(docs.select("text"), ENGLISH, PATTERN).count() == docs.count()


def test_edits_leave_the_rest_alone():
    counter = tokencount.Counter(ENGLISH, PATTERN, segment=64)
    text = "some words that go on and on " * 400
    tree = counter.build(text)
    counter.encoded = 0
    counter.edit(tree, 6000, 6001, "changed")
    assert counter.encoded < 400


def test_line_dedup(awkward, nothing):
    rows = texts(awkward)
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    order = lambda i: (i is None, i or 0)
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            k = key(line)
            first[k] = min(first.get(k, i), i, key=order)
    want = Counter()
    for i, t in rows:
        parts = (t or "").split("\n")
        stay = [x for x in parts if len(key(x)) < 10 or first[key(x)] == i]
        want[(i, len(parts), len(parts) - len(stay), "\n".join(stay))] += 1
    got = lines.dedup_lines(awkward)
    assert bag(got.select("doc.doc_id", "n_lines", "n_dropped", "kept")) == want
    assert got.select("doc.*").columns == awkward.columns
    assert lines.dedup_lines(nothing).count() == 0


def test_hot_lines_take_the_other_way(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("this line is everywhere\nown line number "), "id").alias("text"))
    got = lines.dedup_lines(docs)
    assert got.filter("n_dropped = 1").count() == 2999
    assert got.filter("n_dropped = 0").select("doc.doc_id").first()[0] == 0


def shingles(text, k=5):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * shared >= 75 * (len(sets[i]) + len(sets[j]) - shared):
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    least = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return Counter((rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows)))


def test_jaccard_awkward(awkward, nothing):
    assert bag(jaccard.components(awkward)) == brute_components(texts(awkward))
    assert jaccard.components(nothing).count() == 0


@pytest.mark.parametrize("sublist", [20_000, 3])
def test_jaccard_families(spark, monkeypatch, sublist):
    """Families of texts around the threshold, chains included; long lists split in the second case."""
    import random

    from conftest import SYLLABLES

    monkeypatch.setattr(jaccard, "SUBLIST", sublist)
    rng = random.Random(11)
    rows = []
    for family in range(12):
        words = ["".join(rng.choices(SYLLABLES, k=3)) for _ in range(rng.randint(20, 90))]
        for _ in range(rng.randint(2, 14)):
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = "".join(rng.choices(SYLLABLES, k=3))
            rows.append((len(rows), " ".join(words)))
            if rng.random() < 0.2:
                rows.append((len(rows), " ".join(words).upper()))
            if rng.random() < 0.3:
                words = words[: -rng.randint(1, 4)] or words
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert bag(jaccard.components(docs)) == brute_components(rows)


def test_chunks_give_the_same_shingles(monkeypatch):
    import random

    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("aBbé  \n\tc") for _ in range(rng.randint(0, 300)))
        whole = jaccard.Shingler()(text)
        assert len(whole) == len(shingles(text))
        with monkeypatch.context() as m:
            m.setattr(jaccard, "CHUNK", 20)
            assert (jaccard.Shingler()(text) == whole).all()


@pytest.mark.parametrize("block,chunk", [(1 << 18, 1 << 20), (64, 1 << 20), (1, 20), (200, 40)])
def test_blocks_of_texts_give_each_texts_shingles(monkeypatch, block, chunk):
    import random

    import numpy as np
    import pyarrow as pa

    rng = random.Random(5)
    rows = [None, "", " \n", "one", *("".join(rng.choice("aBbé  \n\tc") for _ in range(rng.randint(0, 120))) for _ in range(700)), None, "a b c d e", ""]
    want = [jaccard.Shingler()(t) for t in rows]
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    shingler = jaccard.Shingler()
    assert list(shingler.blocks(pa.array([], pa.string()))) == []
    for first, last in ((0, len(rows)), (3, 500), (0, 3)):
        got, digests, bits = [], [], []
        for made, bounds in shingler.blocks(pa.array(rows, pa.string()).slice(first, last - first)):
            got += [made[low:high] for low, high in zip(bounds[:-1], bounds[1:])]
            digests += zip(*jaccard.set_digests(made, bounds))
            bits += [*jaccard.parities(made, bounds).reshape(len(bounds) - 1, -1)]
        assert len(got) == last - first and all((g == w).all() and len(g) == len(w) for g, w in zip(got, want[first:last]))
        for g, d, b in zip(got, digests, bits):
            alone = np.array([0, len(g)])
            assert d == tuple(x[0] for x in jaccard.set_digests(g, alone)) and (b == jaccard.parities(g, alone)).all()


def test_only_the_wanted_texts_are_cut_into_shingles_again(spark):
    """One text stands for its set, however many copies and spellings there are; none of the other texts comes back."""
    rows = [(i, f"text number {i} has these words of its own {i * 7}") for i in range(300)]
    rows += [(300 + i, t.upper() if i % 2 else t.replace(" ", "  ")) for i, t in rows[:40]] + [(400, None), (401, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    described, _ = jaccard.describe(docs, 5, 0)
    known = {r.doc_id: r for r in described.collect()}
    classes = described.filter("n_shingles > 0").groupBy("set_id").agg(F.min("text_key").alias("text_key"))
    pairs = spark.createDataFrame([(known[1].set_id, known[2].set_id), (known[1].set_id, known[299].set_id)], "a bigint, b bigint")
    got = {r.set_id: sorted(r.shingles) for r in jaccard.sets_of(docs, jaccard.texts_of(pairs, classes), 5, 0).collect()}
    shingler = jaccard.Shingler(5, 0)
    assert got == {known[i].set_id: sorted(shingler(rows[i][1]).view("int64").tolist()) for i in (1, 2, 299)}


def water(sizes, weights=(1, 2, 3), most=3.0):
    """Targets by repeated sharing: what a stopped source leaves goes to the others by weight."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, open_, rest = {}, set(names), float(sum(sizes.values()))
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] > most * sizes[s]}
        if not over:
            target |= {s: unit * weight[s] for s in open_}
            break
        target |= {s: most * sizes[s] for s in over}
        rest -= sum(target[s] for s in over)
        open_ -= over
    return target


def test_mix(awkward, nothing):
    rows = [(r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in awkward.collect()]
    sizes = defaultdict(int)
    for _, s, n in rows:
        sizes[s] += n
    want = water(sizes)
    planned = mixing.dealt(mixing.plan(awkward, cut=True), shards=5)
    got = planned.collect()
    name = lambda key: None if key == "~" else key[1:]
    assert Counter((r.doc_id, name(r.source_key), r["size"]) for r in got) == Counter(rows)
    taken = defaultdict(int)
    for r in got:
        s = name(r.source_key)
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        mine = sum(u.words for u in r.units)
        assert mine <= 3 * r["size"] and all(0 <= u.shard < 5 for u in r.units)
        taken[s] += mine
    assert all(taken[s] == round(want[s]) for s in sizes)
    again = mixing.dealt(mixing.plan(awkward.repartition(3), cut=True), shards=5).collect()
    assert Counter((r.doc_id, r["size"], str(r.units)) for r in got) == Counter((r.doc_id, r["size"], str(r.units)) for r in again)
    assert mixing.dealt(mixing.plan(nothing)).count() == 0


def test_mixed_texts_hold_the_words_taken(awkward):
    words = F.regexp_count(F.coalesce("doc.text", F.lit("")), F.lit(mixing.WORD))
    mix = mixing.mixed(awkward, shards=5, cut=True)
    assert mix.select("doc.*").columns == awkward.columns
    got = dict(mix.groupBy("doc.source").agg(F.sum(words)).collect())
    rows = [(r.source, len(WORD.findall(r.text or ""))) for r in awkward.collect()]
    sizes = defaultdict(int)
    for s, n in rows:
        sizes[s] += n
    assert {s: got.get(s, 0) for s in sizes} == {s: round(t) for s, t in water(sizes).items()}


def test_exact_draws_at_any_size():
    """Small draws follow the hypergeometric law; draws far beyond the library's own range keep its mean and spread and use no block twice."""
    import numpy as np

    rng = np.random.default_rng(3)
    counts = np.array([7, 0, 12, 5])
    got = np.array([mixing.drawn(9, counts, rng) for _ in range(4000)])
    assert (got.sum(1) == 9).all() and (got <= counts).all()
    assert np.abs(got.mean(0) - 9 * counts / 24).max() < 0.1
    spread = 9 * (counts / 24) * (1 - counts / 24) * (24 - 9) / 23
    assert np.abs(got.var(0) - spread).max() < 0.15
    large = np.array([3_000_000, 1_000_000, 2_000_000])  # by binomials and a correction
    got = np.array([mixing.drawn(2_500_000, large, rng) for _ in range(400)])
    p, share = large / 6_000_000, 2_500_000 / 6_000_000
    assert (got.sum(1) == 2_500_000).all()
    deviation = (got - 2_500_000 * p) / np.sqrt(2_500_000 * p * (1 - p) * (1 - share))
    assert np.abs(deviation.mean(0)).max() < 0.2 and np.abs(deviation.var(0) - 1).max() < 0.3
    huge = np.array([4 * 10**17, 10**9, 3])
    for left in (10**9, 2 * 10**17, 4 * 10**17):
        one = mixing.drawn(left, huge, rng)
        assert one.sum() == left and (one >= 0).all() and (one <= huge).all()


def test_splitting_tree_keeps_quotas(spark):
    quotas = spark.createDataFrame([("=a", 1000), ("=b", 37), ("=c", 0)], "source_key string, blocks bigint")
    rows = mixing.deal(quotas, 37, seed=3).collect()
    per = defaultdict(int)
    shard = defaultdict(int)
    for r in rows:
        per[r.source_key] += r.blocks
        shard[r.shard] += r.blocks
    assert per == {"=a": 1000, "=b": 37, "=c": 0} and len(shard) == 37
    assert max(shard.values()) - min(shard.values()) <= 6


@pytest.mark.parametrize("wide", [512, 2])
def test_spot_signatures(awkward, nothing, monkeypatch, wide):
    monkeypatch.setattr(spotsigs, "WIDE", wide)
    monkeypatch.setattr(spotsigs, "PER_STRETCH", 3)
    rows = sorted(texts(awkward), key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    rows = [(i, t or "") for i, t in rows]
    got = spotsigs.chained(awkward).collect()
    want, near = Counter(), {}
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        n = len(t) // 3
        edited = t[: len(t) - n] + after[:n]
        want[(i, len(t), sha(edited))] += 1
        near[(i, sha(edited))] = (t, edited, after)
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    prints = {}
    for r in got:
        t, edited, after = near[(r.doc_id, r.edited_sha256)]
        a, b, c = (Counter(spotsigs.signatures(x).tolist()) for x in (t, edited, after))
        like = lambda x, y: sum((x & y).values()) / sum((x | y).values()) if x or y else 1.0
        for value, exact in ((r.near_edited, like(a, b)), (r.near_next, like(a, c))):
            assert value == pytest.approx(exact)
        assert prints.setdefault(t, r.fingerprint) == r.fingerprint
    assert spotsigs.chained(nothing).count() == 0


def test_spot_pairs(spark, awkward):
    """Classes and the pairs between them, with null and repeated ids and sixty copies, are those of all pairs."""
    copies = spark.createDataFrame([(1000 + i, "this is the text that was copied and copied again for all of them") for i in range(60)]
                                   + [(2000 + i, " ".join(f"the w{k if k != 60 * i else -i} v{k}" for k in range(250))) for i in range(4)], "doc_id bigint, text string")
    printed = spotsigs.fingerprints(awkward.select("doc_id", "text").union(copies)).select("doc.doc_id", "signatures")
    rows = [(r.doc_id, tuple(r.signatures)) for r in printed.collect()]
    members, pairs = (d.collect() for d in spotsigs.near_pairs(printed, "doc_id", 0.5))
    assert Counter(r.id for r in members) == Counter(i for i, _ in rows)
    held = dict.fromkeys(s for _, s in rows)
    assert len({r.class_id for r in members}) == len(held)
    name = dict(printed.select(F.col("signatures"), F.concat(F.hex(F.xxhash64("signatures")), F.hex(F.xxhash64(F.lit(1), "signatures")))).rdd.map(lambda r: (tuple(r[0]), r[1])).collect())
    like = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b))
    want = {tuple(sorted((name[a], name[b]))): like(a, b) for a in held for b in held if a < b and a and b and like(a, b) >= 0.5}
    got = {tuple(sorted((r.a, r.b))): r.likeness for r in pairs}
    assert got == pytest.approx(want) and len(pairs) == len(got) and want
    assert [d.count() for d in spotsigs.near_pairs(printed.filter("false"), "doc_id")] == [0, 0]


def test_spot_signatures_go_by_the_passage():
    """Near copies on both sides of any number of anchors are alike, and a passage keeps its signatures in any text."""
    import random

    rng = random.Random(5)
    bare = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    like = lambda x, y: spotsigs.likeness(spotsigs.signatures(x), spotsigs.signatures(y))
    for anchors in range(6):
        passage = " the ".join(bare(100) for _ in range(anchors + 1))
        own = set(spotsigs.signatures(passage).tolist())
        assert len(own) >= 80 * (anchors + 1)
        for more in range(1, 6):
            assert like(passage, passage + (" of " + bare(1)) * more) > 0.8
        for others in (bare(30), "this is the end of it and that was all " * 5):
            held = set(spotsigs.signatures(f"{others} {passage} {others}").tolist())
            # those of the 8 words at each end, and the last chains, may differ
            assert len(own - held) <= 2 * (8 + 2)
    assert len(spotsigs.signatures(bare(9))) == 9 and len(spotsigs.signatures("the")) == 1


def test_whole_documents_in_the_mix(spark, awkward, nothing):
    """Without the cut a document is taken whole or not, and each source ends at the border nearest its target."""
    small = spark.createDataFrame([(i, f"s{i}", "one two three four") for i in range(9)], "doc_id bigint, source string, text string")
    for docs, most in ((awkward, 3.0), (small, 3.0), (awkward, 1.5)):
        sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
        rows = [(r.source, len(WORD.findall(r.text or ""))) for r in docs.collect()]
        for s, n in rows:
            sizes[s] += n
            largest[s] = max(largest[s], n)
        planned = mixing.dealt(mixing.plan(docs, most=most), shards=5).collect()
        for r in planned:
            assert all(u.words == r["size"] for u in r.units)
            taken[None if r.source_key == "~" else r.source_key[1:]] += sum(u.words for u in r.units)
        for s, target in water(sizes, most=most).items():
            assert taken[s] <= most * sizes[s]
            assert abs(taken[s] - target) <= largest[s] / 2 + 1 or taken[s] + largest[s] > most * sizes[s]
    got = Counter((r.doc.doc_id, r.doc.text) for r in mixing.mixed(awkward, shards=5).collect())
    assert set(got) <= {(r.doc_id, r.text) for r in awkward.collect()}
    assert sum(len(WORD.findall(t or "")) * n for (_, t), n in got.items()) == sum(u.words for r in mixing.dealt(mixing.plan(awkward)).collect() for u in r.units)
    assert mixing.dealt(mixing.plan(nothing)).count() == 0


def test_mix_query_takes_whole_documents(spark):
    from beamwright.llm.queries import QUERIES

    rows = QUERIES["op3_source_mix"](spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r.taken % r["size"] == 0 if r["size"] else r.taken == 0 for r in rows)
