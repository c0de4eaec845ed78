"""The corpus pipeline against a plain run of its stages' rules, and the guard of the registry."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_text_operators import KINDS, corpus

import corpus_pipeline
from pricegrain.llm import packing, secrets, simhash
from pricegrain.llm.common import local_components


@pytest.fixture(scope="module")
def rows():
    return corpus()


def test_stages_and_their_columns(spark, rows, tmp_path):
    docs = spark.createDataFrame(rows, KINDS)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "secrets", "mix", "pack"]
    out = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out, "").write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "pack":
            assert out.schema.names == docs.schema.names
        seen[name] = out.collect()
    lettered = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    clear = seen["language"]
    assert {r["doc_id"] for r in clear} <= {r[0] for r in lettered} and {r["doc_id"] for r in clear} >= set(range(76))
    one_each = seen["near_duplicates"]
    assert sorted(map(last, (r["doc_id"] for r in one_each))) == sorted(map(last, plain_kept(clear)))
    assert len(seen["secrets"]) == len(one_each)
    for r in seen["secrets"]:
        assert not secrets.base_spans(r["text"]) and r["n_chars"] == len(r["text"])
    copies = {}
    for r in seen["mix"]:
        copies[r["doc_id"]] = copies.get(r["doc_id"], 0) + 1
    assert set(copies) <= {r["doc_id"] for r in seen["secrets"]} and max(copies.values()) <= 3
    text = {r["doc_id"]: r["text"] for r in seen["secrets"]}
    encoder = packing.Encoder.at(packing.default_vocabulary())
    total = sum(n * (len(encoder.ids(text[i])) // 4 + 1) for i, n in copies.items())
    assert sum(r["length"] for r in seen["pack"]) == total


def test_stages_take_empty_tables(spark):
    out = spark.createDataFrame([], KINDS)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, out, "")
        assert out.count() == 0


def test_run(spark, rows, tmp_path):
    spark.createDataFrame(rows, KINDS).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 20


def test_entry_registers_every_operator():
    import __spark_entry__ as entry

    names = entry.queries()
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def plain_shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def last(x):
    return (x is None, x)


def plain_kept(docs):
    """The smallest id, null last, of each group that five-word similarities of 0.8 or more join, by brute force."""
    sets = [plain_shingles(r["text"]) for r in docs]
    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if docs[i]["text"] == docs[j]["text"] or 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])]
    a, b = zip(*pairs)
    least = {}
    for k, r in zip(local_components(len(sets), np.array(a), np.array(b)), docs):
        least[k] = min(least.get(k, (True, None)), last(r["doc_id"]))
    return [x for _, x in least.values()]


@pytest.mark.parametrize(("often", "cap", "sent"), [(3, 1024, 1 << 20), (10**9, 8, 0)])
def test_near_duplicates_are_all_pairs_of_similar_shingles(spark, monkeypatch, often, cap, sent):
    for name, value in (("OFTEN", often), ("SHARD_CAP", cap), ("SENT", sent), ("FILED", 50 * cap), ("FIRST", 1 if cap == 8 else 4), ("BLOCK", 2 if cap == 8 else 256), ("COME", 3 if cap == 8 else 4096)):
        monkeypatch.setattr(simhash, name, value)
    r = random.Random(11)
    vocabulary = [f"w{i}" for i in range(900)]
    line, rows = " ".join(r.choices(vocabulary, k=30)), []
    for _ in range(60):
        base = r.choices(vocabulary, k=r.randrange(3, 120))
        for _ in range(r.randrange(1, 7)):
            near = list(base)
            for _ in range(r.randrange(0, 4)):
                near[r.randrange(len(near))] = r.choice(vocabulary)
            rows.append((len(rows), " ".join(near) + (" " + line if r.random() < 0.5 else ""), "en", "s", 1, "", ""))
    r.shuffle(rows)
    rows += [rows[3], (None, rows[4][1], "en", "s", 1, "", ""), (None, "of its own", "en", "s", 1, "", ""), (7000, "two texts", "en", "s", 1, "", ""), (7000, "under one id", "en", "s", 1, "", "")]
    want = plain_kept([dict(zip(("doc_id", "text"), x)) for x in rows])
    found = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, KINDS).repartition(5), "").collect()
    assert sorted((last(x["doc_id"]) for x in found)) == sorted(map(last, want)) and len(found) < len(rows)


def test_order_of_shingles_counts_every_text(spark):
    """A line is frequent though only texts hold it whose keys a sample of one in 16 leaves out: none is listed under it."""
    line = "one line that stands in very many texts of all these"
    texts = spark.range(22_000).select(F.concat_ws(" ", *[F.concat(F.lit(f"a{k}x"), "id") for k in range(20)], F.lit(line)).alias("text"))
    texts = texts.withColumn("key", F.xxhash64("text")).where("pmod(key, 16) <> 0").cache()
    assert texts.count() > 20_000
    own = simhash.hashes(line, 5).view(np.int64).tolist()
    assert simhash._filed(texts, 5, 80)[0].where(F.col("item").isin(own)).count() == 0
    want = np.zeros(simhash.SLOTS, np.int64)
    for r in texts.select("text").collect():
        np.add.at(want, simhash._slot(np.unique(simhash.hashes(r["text"], 5))), 1)
    assert np.array_equal(simhash._counts(texts, 5), np.where(want < simhash.OFTEN, 0, want))


def test_similar_texts_with_distant_fingerprints_are_near_copies(spark):
    near = "w7624 w9712 w885 w2478 w3658 w1398 w8477 w5939"
    far = f"{near} x74644"
    assert len(plain_shingles(near) & plain_shingles(far)) / len(plain_shingles(far)) == 0.8
    assert (simhash.fingerprint(near, 5) ^ simhash.fingerprint(far, 5)).bit_count() == 33
    rows = [(i, t, "en", "s", 1, "", "") for i, t in enumerate([near, far, "some other text"])]
    found = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, KINDS), "").collect()
    assert sorted(r["doc_id"] for r in found) == [0, 2]


def test_clashing_columns_and_repeats_pass_the_stages(spark):
    """Extra columns of any name come through unchanged; every row keeps its own."""
    kinds = "doc_id long, text string, lang string, source string, n_chars long, key string, mark string, id string, copies string, _text string, _clean string, _copies string, c0 string, label string, lang_pred string"
    extra = tuple(f"x{i}" for i in range(10))
    rows = [(i, f"the {i} and that with from this have they were " * (1 + i % 3), "en", "s", 1, *extra) for i in range(40)]
    rows += [rows[5], rows[5], (41, "Word " * 3000, "en", None, None, *extra), (42, "", "en", "s", 0, *extra), (43, None, None, None, None, *extra)]
    docs = spark.createDataFrame(rows, kinds)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        found = out.collect()
        assert found and all(tuple(r)[5:] == extra for r in found)
