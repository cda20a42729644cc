"""The archive, the search, the classifiers, the registered queries and the pipeline."""

import base64
import hashlib
from collections import Counter, defaultdict

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_texts import ENGLISH, MULTI, WORD, brute_components, sha, tiktoken_of, water

from beamwright.llm import lines, quality, toxicity, vptree, warc
from beamwright.llm.common import held_out, written
from beamwright.llm.queries import QUERIES, SQL
from beamwright.session import scratch_dir

FOLDER = "/root/testdata/sf0.001"


def page_rows():
    big = "é" * 200_000
    rows = [(5, "http://a/", "same"), (3, "http://b/\r\nX: y", "same"), (9, None, "same"), (None, "u", "same"), (4, "u", None), (6, "u", ""), (7, "u", big), (8, "u", big),
            (None, "u", "only nameless"), (None, "v", "only nameless"), (3, "http://b/\r\nX: y", "same"), (10, "u", "\r\n\r\nWARC-Type: revisit\r\n")]
    return rows + [(100 + i, "u", "very common page") for i in range(300)]


def test_archive(spark):
    schema = "page_id bigint, url string, html string, n string, address string, header string"
    pages = spark.createDataFrame([(*r, "n", "a", "h") for r in page_rows()], schema).repartition(6)
    folder = scratch_dir(spark, "warc-test")
    warc.write_archive(pages, folder)
    records = warc.read_archive(spark, folder)
    first = {}
    for i, _, h in page_rows():
        h = h or ""
        first[h] = min((x for x in (first.get(h), i) if x is not None), default=None)
    want = Counter()
    for i, _, h in page_rows():
        body = (h or "").encode()
        own = i == first[h or ""]
        want[(i, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "response" if own else "revisit", None if own else first[h or ""])] += 1
    assert Counter(tuple(r)[:5] for r in warc.describe(records).collect()) == want
    assert spark.read.parquet(f"{folder}/payloads").count() == len(first)
    for r in records.collect():
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        length = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert rest[length:] == b"\r\n\r\n" and head.startswith(b"WARC/1.1\r\n")
        assert rest[:length].partition(b"\r\n\r\n")[2] == (bytes(r.payload) if b"WARC-Type: response" in head else b"")


def test_empty_and_damaged_archive(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    folder = scratch_dir(spark, "warc-test")
    warc.write_archive(pages, folder)
    assert warc.describe(warc.read_archive(spark, folder)).count() == 0
    pages = spark.createDataFrame([(1, "u", "text")], pages.schema)
    folder = scratch_dir(spark, "warc-test")
    warc.write_archive(pages, folder)
    damaged = scratch_dir(spark, "warc-test")
    spark.read.parquet(f"{folder}/payloads").withColumn("payload", F.lit("other").cast("binary")).write.parquet(f"{damaged}/payloads")
    spark.read.parquet(f"{folder}/records").write.parquet(f"{damaged}/records")
    with pytest.raises(Exception, match="differs from its digest"):
        warc.describe(warc.read_archive(spark, damaged)).collect()


def brute_nearest(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for i, q in ok:
        if i % 100 == 0:
            found = [(vptree.distances(q[None], v[None])[0, 0], j) for j, v in ok if j != i and len(v) == len(q)]
            out[i] = sorted(found)[:k]
    return out


@pytest.mark.parametrize("shard_rows", [8192, 150])
def test_vantage_points_exact(spark, shard_rows):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(900)]
    rows += [(1000 + i, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for i in range(400)]
    rows += [(2000, None), (2100, [0.0] * 6), (2200, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2300, [float("nan")] * 6), (2400, [float("inf")] * 6), (None, [1.0] * 6), (2500, []),
             (2600, [3.0, 4.0]), (2601, [3.0, 5.0]), (0, rows[0][1])]
    vectors = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id bigint, embedding array<double>, id string, shard int").repartition(5)
    got = defaultdict(list)
    for r in sorted(vptree.nearest(vectors, vectors.filter("vec_id % 100 = 0"), shard_rows=shard_rows).collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append((r.score, r.vec_id))
    assert got == {i: x for i, x in brute_nearest(rows, 10).items() if x}


def test_relaxed_search_recall_and_empty(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    queries = vectors.filter("vec_id % 100 = 0")
    exact = {(r.query_id, r.vec_id) for r in vptree.nearest(vectors, queries).collect()}
    relaxed = {(r.query_id, r.vec_id) for r in vptree.nearest(vectors, queries, factor=1.5).collect()}
    assert len(exact & relaxed) >= 0.9 * len(exact)
    assert vptree.nearest(vectors.filter("false"), queries).count() == 0
    assert vptree.nearest(vectors, queries.filter("false")).count() == 0


def test_classifiers_on_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, None, 1), (None, 1, 1), (3, 1, 0), (100, 0, 1), (101, 0, 1), (5000, 1, 1)], "doc_id bigint, quality int, toxic int")
    for module in (quality, toxicity):
        name = "quality" if module is quality else "toxic"
        for marks in (labels, labels.filter("false"), labels.withColumn(name, F.lit(1))):
            model = module.fit(awkward, marks, name)
            scored = module.score(awkward, model)
            rows = scored.select("held_out", "score", "predicted").collect()
            assert len(rows) == awkward.count() and all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
            again = module.score(awkward.repartition(2), module.fit(awkward.repartition(7), marks, name))
            assert sorted(r.score for r in rows) == pytest.approx(sorted(r.score for r in again.collect()))
        assert module.score(nothing, model).count() == 0
        assert module.score(awkward, module.fit(nothing, labels, name)).count() == awkward.count()


def test_held_out_rows_teach_nothing(spark):
    import zlib

    ids = spark.range(200).withColumn("out", held_out(F.col("id"))).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in ids)
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.fit(docs, marks, "quality") for marks in (labels, turned))
    assert np.allclose(a["vectors"] @ a["vectors"].T, b["vectors"] @ b["vectors"].T)


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    good = quality.score(docs, quality.fit(docs, labels)).select("doc.doc_id", "held_out", "score", "predicted").join(labels, "doc_id").filter("held_out").toPandas()
    assert (good.predicted == good.quality).mean() > 0.99
    toxic = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").filter("held_out").toPandas()
    assert (toxic.predicted == toxic.toxic).mean() > 0.95
    pos, neg = toxic[toxic.toxic == 1].score, toxic[toxic.toxic == 0].score
    assert np.mean([(p > neg).mean() for p in pos]) > 0.93


@pytest.mark.parametrize("name", list(SQL))
def test_query_sql(spark, name):
    compare.check(spark, compare.duck(FOLDER), name, QUERIES[name], SQL[name], FOLDER)


def test_token_query_whole_table(spark):
    docs = dict(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect())
    enc = tiktoken_of(ENGLISH)
    rows = QUERIES["op2_token_counts"](spark, FOLDER).collect()
    assert len(rows) == len(docs)
    for r in rows:
        t = docs[r.doc_id] or ""
        n = len(t)
        for a, b, c in ((n // 2, n // 2, " an added\n\n passage of 12 words"), (n // 4, n // 4 + n // 10, ""), (n - 3, n - 2, "X's ")):
            a = min(max(a, 0), len(t))
            b = min(max(b, a), len(t))
            t = t[:a] + c + t[b:]
        assert (r.n_tokens, r.n_tokens_edited, r.edited_sha256) == (len(enc.encode_ordinary(docs[r.doc_id] or "")), len(enc.encode_ordinary(t)), sha(t))


def test_pipeline_stage_by_stage(spark):
    """Each stage against brute force on what the stage before it kept."""
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept, columns = [docs], docs.columns
    for _, stage in p.STAGES:
        folder = scratch_dir(spark, "stage-test")
        stage(spark, kept[-1], FOLDER).write.parquet(folder)
        kept.append(spark.read.parquet(folder))
    assert all(d.columns == columns for d in kept[:-1])
    rows = [[r.asDict() for r in d.collect()] for d in kept]
    votes = {r.doc_id: r.predicted for r in QUERIES["op7_quality_votes"](spark, FOLDER).collect()}
    assert Counter(r["doc_id"] for r in rows[1]) == Counter(r["doc_id"] for r in rows[0] if votes[r["doc_id"]])

    seen, want = {}, {}
    for r in sorted(rows[1], key=lambda r: r["doc_id"]):
        keys = [x.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(lines.UPPER, lines.LOWER)) for x in r["text"].split("\n")]
        for k in keys:
            seen.setdefault(k, r["doc_id"])
        want[r["doc_id"]] = "\n".join(x for x, k in zip(r["text"].split("\n"), keys) if len(k) < 10 or seen[k] == r["doc_id"])
    assert {r["doc_id"]: r["text"] for r in rows[2]} == want

    groups = brute_components([(r["doc_id"], r["text"]) for r in rows[2]])
    assert Counter(r["doc_id"] for r in rows[3]) == Counter({i: 1 for i, _, least in groups if i == least})

    sizes, taken, own = defaultdict(int), defaultdict(int), {}
    for r in rows[3]:
        sizes[r["source"]] += len(WORD.findall(r["text"]))
        own[r["doc_id"]] = r["text"]
    for r in rows[4]:
        assert own[r["doc_id"]] == r["text"] and r["n_chars"] == len(r["text"])
        taken[r["source"]] += len(WORD.findall(r["text"]))
    longest = {s: max(len(WORD.findall(r["text"])) for r in rows[3] if r["source"] == s) for s in sizes}
    assert all(abs(taken[s] - t) <= longest[s] / 2 + 1 or taken[s] + longest[s] > 3 * sizes[s] for s, t in water(sizes).items())

    enc = tiktoken_of(MULTI)
    ids = Counter((r["doc_id"], tuple(enc.encode_ordinary(r["text"])), sha(r["text"])) for r in rows[4])
    assert Counter((r["doc_id"], tuple(r["ids"]), r["decoded_sha256"]) for r in rows[5]) == ids


def test_near_duplicates_without_or_with_repeated_ids(spark):
    """One document a group, whatever ids its members lack or share with documents of other groups."""
    import random

    import corpus_pipeline as p

    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"

    def family(n):
        words = [word() for _ in range(80)]
        return [" ".join(words[:-1] + [word()]) for _ in range(n)]

    a, b, c, d, e, f = (family(n) for n in (4, 1, 3, 1, 2, 2))
    rows = [(None, a[0]), (None, a[1]), (5, a[2]), (7, a[3]), (7, d[0]), (None, b[0]), (None, c[0]), (None, c[1]), (None, c[2]),
            (None, c[2]), (9, e[0]), (9, e[1]), (None, f[0]), (11, f[1]), (11, f[1]), (None, ""), (None, None), (12, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = [tuple(r) for r in p.near_duplicates(spark, docs, FOLDER).collect()]
    assert set(got) <= set(rows)
    groups = {t: k for k, texts in enumerate((a, b, c, d, e, f)) for t in texts}
    kept = Counter((i, groups.get(t, t)) for i, t in got)
    assert kept == Counter([(5, 0), (None, 1), (None, 2), (7, 3), (9, 4), (11, 5), (None, ""), (None, None), (12, "")])


def test_pipeline_with_awkward_documents(spark, awkward, nothing, tmp_path):
    """Nulls, empty tables, repeats, clashing names and missing labels: no label to judge by keeps every document, no text is cut."""
    import corpus_pipeline as p

    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    for k, (docs, marks) in enumerate([(awkward, labels.filter("false")), (awkward, labels.withColumn("quality", F.lit(0))), (nothing, labels.filter("false"))]):
        folder = f"{tmp_path}/{k}"
        marks.write.parquet(f"{folder}/labels.parquet")
        docs.write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([], "doc_id bigint").write.parquet(f"{folder}/other.parquet")
        stages, now = dict(p.STAGES), spark.read.parquet(f"{folder}/documents.parquet")
        kept = stages["quality classifier"](spark, now, folder)
        assert kept.columns == docs.columns and kept.count() == docs.count()
        if k == 1:
            continue
        for name, stage in p.STAGES[1:4]:
            before, now = {(r.doc_id, r.text) for r in now.collect()}, written(stage(spark, now, folder), "awkward-stage")
            assert now.columns == docs.columns, name
        assert {(r.doc_id, r.text) for r in now.collect()} <= before
        out = p.run(spark, folder)
        assert (out.count() == 0) == (k == 2)


def test_votes_match_a_plain_loop():
    """Nearest neighbours and their votes, one cosine at a time; word terms tell texts of equal shapes apart."""
    rng = np.random.default_rng(4)
    vectors = quality.unit(rng.normal(size=(60, 5)))
    labels = rng.integers(0, 2, 60).astype(float)
    model = {"weights": rng.random(quality.TERMS).astype(np.float32), "basis": rng.normal(size=(quality.TERMS, 5)), "vectors": vectors, "labels": labels, "mean": 0.25}
    texts = ["the good results were found", "xqz kjhg zzzzzzz qwer plmok", "", "A line\nA line\n12 34", "x" * 300, "the good results were found the good"]
    rows = quality.matrix(quality.Terms(), texts)
    assert not (rows[0, quality.STYLE :] == rows[1, quality.STYLE :]).all() and rows[0].sum() > 0
    got = quality.votes(model, rows, k=7, power=3.0)
    for row, score in zip(rows.astype(float), got):
        place = [float(sum(row[i] * model["weights"][i] * model["basis"][i, j] for i in np.flatnonzero(row))) for j in range(5)]
        length = sum(x * x for x in place) ** 0.5
        near = sorted(((sum(a * b for a, b in zip(place, v)) / length if length else 0.0, y) for v, y in zip(vectors, labels)), key=lambda x: -x[0])[:7]
        weight = [max(c, 0.0) ** 3 for c, _ in near]
        want = sum(w * y for w, (_, y) in zip(weight, near)) / sum(weight) if sum(weight) else 0.25
        assert score == pytest.approx(want, abs=1e-4)
    counts = rows[5, quality.STYLE :] ** 2  # the root is undone
    assert counts.sum() == pytest.approx(7) and sorted(counts[counts > 0].round().tolist()) == [1, 1, 1, 2, 2]
