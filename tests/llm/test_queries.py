"""The registered queries and the pipeline over the smallest tables."""

import zlib
from collections import defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from folioscope.llm import queries, stages

FOLDER = contract.SMOKE_DIR


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_matches_sql(spark, name):
    engine = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        engine.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    want = engine.execute(queries.SQL[name])
    columns = sorted(c[0] for c in want.description)
    order = [c[0] for c in want.description]
    theirs = sorted(repr([row[order.index(c)] for c in columns]) for row in want.fetchall())
    found = queries.QUERIES[name](spark, FOLDER)
    assert sorted(found.columns) == columns
    assert sorted(repr([row[c] for c in columns]) for row in found.collect()) == theirs


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_query_gives_a_row_per_input_row(spark, name):
    found = queries.QUERIES[name](spark, FOLDER).toPandas()
    key = next(c for c in ("doc_id", "vec_id", "conv_id") if c in found)
    table = {"doc_id": "documents", "vec_id": "embeddings", "conv_id": "conversations"}[key]
    ids = spark.read.parquet(f"{FOLDER}/{table}.parquet").select(key).toPandas()[key]
    if key == "conv_id":  # rows by turn
        ids = ids.drop_duplicates()
    if "piece" in found:
        found = found[found["piece"] == 0]
    assert sorted(found[key][found[key] != -7]) == sorted(ids)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:3]:
        kept = stage(spark, docs, FOLDER).cache()
        assert kept.columns == docs.columns
        assert kept.exceptAll(docs).isEmpty()
        docs = kept
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    files = lambda: {p for p in shared.rglob("*") if p.is_file()}
    before = files()
    packed = corpus_pipeline.run(spark, FOLDER)
    left = {p.parent.name for p in files() - before}
    assert left == {corpus_pipeline.STAGES[-1][0]}
    packed = packed.toPandas()
    assert set(packed["doc_id"]) == set(docs.toPandas()["doc_id"])


def test_stages_keep_one_row_of_each(spark):
    fox = "the quick brown fox jumps over the lazy dog again and again today"
    table = [(1, fox, 1), (1, fox, 1), (2, fox.upper(), 2), (3, "other", 3), (None, "other", 4), (None, None, 5)]
    docs = spark.createDataFrame(table, "doc_id long, text string, n_chars int")
    kept = stages.without_copies(docs).collect()
    assert sorted(r.n_chars for r in kept) == [2, 3, 5]
    near = stages.without_near_copies(docs).collect()
    assert sorted(r.n_chars for r in near) == [1, 3, 5]
    nameless = docs.selectExpr("CAST(NULL AS BIGINT) AS doc_id", "'the same text' AS text", "n_chars").limit(1)
    fifty = nameless.crossJoin(spark.range(50)).drop("id")
    assert stages.without_copies(fifty).count() == stages.without_near_copies(fifty).count() == 1
    beside = fifty.union(spark.createDataFrame([(9, "the same text", 90), (8, "the same text ", 80)], fifty.schema))
    assert sorted(r.n_chars for r in stages.without_copies(beside).collect()) == [80, 90]
    assert [r.n_chars for r in stages.without_near_copies(beside).collect()] == [80]
    assert stages.without_copies(docs.limit(0)).count() == 0
    assert stages.without_near_copies(docs.limit(0)).count() == 0
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert stages.without_toxic(docs, labels).count() == 6
    clashing = docs.selectExpr("*", "7 AS predicted", "'x' AS Score", "0 AS row")
    assert stages.without_toxic(clashing, labels).exceptAll(clashing).isEmpty()
    assert stages.without_toxic(clashing, labels).columns == clashing.columns


def test_near_dedup_keeps_texts_that_share_an_id(spark):
    fox = "the quick brown fox jumps over the lazy dog again and again today"
    wizards = "seven wizards box quietly near an old harbour while the rain keeps on falling"
    table = [(5, fox, 1), (5, wizards, 2), (6, fox.upper(), 3), (7, wizards.upper(), 4), (8, "other", 5)]
    docs = spark.createDataFrame(table, "doc_id long, text string, n_chars int")
    assert sorted(r.n_chars for r in stages.without_near_copies(docs).collect()) == [1, 2, 5]
    one_id = spark.createDataFrame([(1, f"{k} " * 20, k) for k in range(30)], "doc_id long, text string, n_chars int")
    prints = {r.fingerprint for r in stages.simhash.near_duplicates(one_id, distance=0).collect()}
    assert stages.without_near_copies(one_id, distance=0).count() == len(prints) > 20


def plain_pipeline(table, hostile, words=3, distance=2):
    """Ids and texts that the three filtering stages leave, by comparing all texts with all."""
    left = [(who, text) for who, text in table if not any(stem in text for stem in hostile)]
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    last = {}
    for who, text in left:
        last[text.translate(small)] = max(last.get(text.translate(small), (who, text)), (who, text))
    left = sorted(last.values())

    def fingerprint(text):
        found = text.encode().lower().split()
        grams = [b" ".join(found[k : k + words]) for k in range(max(1, len(found) - words + 1))] if found else []
        ones = [sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) for b in range(64)]
        return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams)) if grams else 0

    prints = [fingerprint(text) for _, text in left]
    label = list(range(len(left)))
    for i in range(len(left)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return [left[k] for k in range(len(left)) if label[k] == k]  # sorted, so the first has the smallest id


def test_pipeline_gives_the_rows_of_plain_code(spark, tmp_path):
    rng = np.random.default_rng(8)
    vocabulary = [f"{a}{b}" for a in ("lan", "mor", "tes", "pil", "run", "gad") for b in ("o", "ira", "eth", "um", "ys")]
    hostile = ("zorgl", "vrakk")

    def text(size, toxic):
        found = list(rng.choice(vocabulary, size=size))
        for _ in range(10 if toxic else 0):
            found.insert(int(rng.integers(0, size)), str(rng.choice(hostile)) + str(rng.choice(["a", "en", "ou"])))
        return " ".join(found)

    table = [(k, text(int(rng.integers(20, 60)), k % 4 == 0)) for k in range(400)]
    labels = [(who, int(who % 4 == 0)) for who, _ in table]
    clean = [t for who, t in table if who % 4]
    table += [(1000 + k, t.upper()) for k, t in enumerate(clean[:20])]
    table += [(2000 + k, t.replace(" ", "  ", 1)) for k, t in enumerate(clean[10:40])]
    table += [(3000 + k, t.replace(" ", " \n", 2) + " end") for k, t in enumerate(clean[30:60])]
    table += [(7, text(30, False)), (7, text(50, False)), (4000, text(9000, False)), (4001, ""), (4002, "")]
    docs = spark.createDataFrame(table, "doc_id long, text string").repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    left = plain_pipeline(table, hostile)
    assert 250 < len(left) < len(table) - 150 and sum(who == 7 for who, _ in left) == 2
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = []
    for who, words in left:
        ids = np.array(library.encode(words, add_special_tokens=False).ids + [0], dtype="<u4")
        edges = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(edges, edges[1:])):
            pieces.append((who, k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == sorted(pieces)
    bins = defaultdict(list)
    for r in found:
        bins[r.sequence_id].append((r.offset, r.length))
    for placed in bins.values():
        ends = [a + n for a, n in sorted(placed)]
        assert [a for a, _ in sorted(placed)] == [0, *ends[:-1]] and ends[-1] <= 2048
    free = []
    for length in sorted((p[3] for p in pieces), reverse=True):
        fits = [k for k, space in enumerate(free) if space >= length]
        if fits:
            free[min(fits, key=lambda k: free[k])] -= length
        else:
            free.append(2048 - length)
    assert len(bins) == len(free)
