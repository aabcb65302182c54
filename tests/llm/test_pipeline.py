import itertools
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyquilt.llm import lines, neardup, toxicity
from test_llm import line_groups, vocabulary


@pytest.fixture(scope="module")
def corpus():
    """doc_id and text: near copies, repeated lines, a toxic word, repeated ids, nulls and empty texts."""
    r, v, rows = random.Random(20), vocabulary(20, 900), []
    for k in range(60):
        words = r.choices(v, k=r.randint(20, 120))
        text = " ".join(words[: len(words) // 2]) + "\n" + " ".join(words[len(words) // 2 :])
        rows.append((10 * k, text))
        if k % 4 == 0:
            rows.append((10 * k + 1, text))
        if k % 4 == 1:  # words at other places, so that lines are unlike and shingles alike
            rows.append((10 * k + 2, " ".join(words) + " tail of its own"))
        if k % 5 == 0:
            rows.append((10 * k + 3, "zzbad " + " ".join(r.choices(v, k=30))))
    rows += [(7, "unique text under an id that repeats"), (7, rows[0][1]), (7, "unique text under an id that repeats"), (None, "no id at all"), (8, None), (9, ""), (11, " \n ")]
    return rows


@pytest.fixture(scope="module")
def tables(spark, corpus, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    df = spark.createDataFrame(corpus, "doc_id long, text string")
    df = df.withColumns({"n_chars": F.length("text").cast("long"), **{c: F.lit("x") for c in ("_doc", "_row", "_gone", "_left", "task", "node", "component", "hub", "keep")}})
    df.write.parquet(f"{at}/documents.parquet")
    labels = [(d, 1, int((t or "").startswith("zzbad"))) for d, t in corpus if d is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return at


def texts(df):
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)


def without_lines(rows):
    gone, out = line_groups([(d, t) for d, t in rows if d is not None and t is not None]), []
    for d, t in rows:
        own = (t or "").split("\n")
        left = [x for k, x in enumerate(own) if (d, k) not in gone]
        if len(left) == len(own):
            out.append((d, t))
        elif any(x.strip(" ") for x in left):
            out.append((d, "\n".join(left)))
    return out


def without_near(rows):
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in ((t or "").lower().split() for _, t in rows)]
    up = list(range(len(rows)))
    usable = [k for k, (d, _) in enumerate(rows) if d is not None and sets[k]]
    for a, b in itertools.combinations(usable, 2):
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((up[a], up[b]))
            up = [x if u == y else u for u in up]
    least = {u: min(rows[k][0] for k in usable if up[k] == u) for u in {up[k] for k in usable}}
    return [row for k, row in enumerate(rows) if k not in usable or row[0] == least[up[k]]]


def test_stages_against_brute_force(spark, corpus, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, rows = docs.columns, corpus
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tables)
        assert docs.columns == columns
        if name == "toxicity":
            rows = [(d, t) for d, t in rows if not (t or "").startswith("zzbad")]
        elif name == "line_dedup":
            # Lines of rows that repeat an id are told apart by their text, which this brute force doesn't do.
            assert [x for x in texts(docs) if x[0] != 7] == sorted([x for x in without_lines([x for x in rows if x[0] != 7]) if x[0] != 7], key=str)
            rows = texts(docs)
            assert (7, "unique text under an id that repeats") in rows and all(t != corpus[0][1] for d, t in rows if d == 7)
        else:
            was, rows = len(rows), without_near(rows)
        assert texts(docs) == sorted(rows, key=str)
    assert len(rows) < was  # near copies were left for the third stage
    out = corpus_pipeline.STAGES[-1][1](spark, docs, tables)
    got = {tuple(r) for r in out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()}
    assert got == {tuple(r) for r in corpus_pipeline.run(spark, tables).select("doc_id", "start", "length", "ids_crc32", "doc_tokens").collect()}
    packed = out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("to")).collect()
    assert all(r["n"] == r["to"] <= 2048 for r in packed)
    tokens = {}
    for d, _, length, _, n in got:
        tokens.setdefault((d, n), []).append(length)
    assert sum(n == 1 for _, n in tokens) == sum(not (t or "").strip() for _, t in rows)  # nothing is packed empty but what was


def test_stages_on_empty_tables(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, tables).count() == 0


def test_near_duplicates_of_repeated_ids(spark):
    r, v = random.Random(21), vocabulary(21)
    t, u = (" ".join(r.choices(v, k=60)) for _ in range(2))
    df = spark.createDataFrame([(1, t), (5, t), (5, u), (6, u + " more"), (1, t), (None, t)], "doc_id long, text string").withColumns({"_doc": F.lit(1), "_row": F.lit(2)})
    got = sorted(((x["doc_id"], x["component_id"], x["kept"]) for x in neardup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (5, 1, False), (5, 5, True), (6, 5, False), (None, None, True)], key=str)
    left = neardup.drop_near_duplicates(df)
    assert left.columns == df.columns and texts(left) == sorted([(1, t), (1, t), (5, u), (None, t)], key=str)


def test_chain_against_brute_force(spark):
    """The scores are those of the fitted weights, added up word by word; later links get the odds of earlier ones."""
    r, v = random.Random(22), vocabulary(22)
    docs = [(i, " ".join(r.choices(v, k=25) + ["zzjunk"] * (i % 3 == 0) + ["zzbad"] * (i % 4 == 0))) for i in range(300)] + [(400, None), (401, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 4 == 0)) for i in range(300)], "doc_id long, a int, b int")
    chain = toxicity.fit_chain(df, labels, ["a", "b"])
    import xxhash

    got = {x["doc_id"]: (x["p_a"], x["p_b"]) for x in toxicity.predict(df, chain).collect()}
    for i, t in docs:
        odds = []
        for link in chain:
            s = link.bias + sum(link.weights.get(xxhash.xxh32_intdigest(w), 0.0) for w in toxicity.words_of(t))
            odds.append(s + sum(c * max(-10, min(10, o)) for c, o in zip(link.chain, odds, strict=True)))
        assert got[i] == pytest.approx([1 / (1 + np.exp(-o)) for o in odds])
    assert len(chain[1].chain) == 1 and sum((got[i][1] > 0.4) == (i % 4 == 0) for i in range(300)) >= 297


def test_names(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "packing"]
    assert lines.PER_CENT == 80 and public_tokenizers.path(corpus_pipeline.WORDS)
