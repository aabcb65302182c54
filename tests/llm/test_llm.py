import hashlib
import itertools
import random
import textwrap
import tracemalloc
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyquilt.llm import chat, licenses, lines, neardup, neighbours, packing, search, tokens, toxicity, warc
from skyquilt.plans.scratch import Scratch

DOCS = "doc_id long, text string, component string, hub string"
ODD = [(1, None, "a", "b"), (2, "", "a", "b"), (3, " \n\t", None, None), (4, "x" * 50_000 + " é\r\n" * 3, "c", "d"), (None, "no id here at all", "e", "f"), (5, "same text twice", "g", "h"), (5, "same text twice", "g", "h")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def vocabulary(seed, n=400):
    r = random.Random(seed)
    return ["".join(r.choices("abcdefghijklmnop", k=r.randint(2, 9))) for _ in range(n)]


def test_near_duplicates_against_brute_force(spark):
    r, v, texts = random.Random(1), vocabulary(1), []
    for _ in range(25):
        base = r.choices(v, k=r.randint(3, 200))
        for _ in range(r.randint(1, 6)):
            own = list(base)
            for _ in range(r.randint(0, 4)):
                own[r.randrange(len(own))] = r.choice(v)
            texts.append(" ".join(own))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x["doc_id"]: (x["component_id"], x["n_shingles"]) for x in neardup.near_duplicates(df, 3, 85).collect()}
    sets = [{tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} for w in map(str.split, texts)]
    up = list(range(len(sets)))
    for a, b in itertools.combinations(range(len(sets)), 2):
        if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
            x, y = sorted((up[a], up[b]))
            up = [x if u == y else u for u in up]
    assert got == {i: (up[i], len(sets[i])) for i in range(len(sets))}


def test_near_duplicates_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 300)
    v = vocabulary(2)
    base = random.Random(2).choices(v, k=80)
    df = spark.createDataFrame([(i, " ".join(base[:i] + ["changed"] + base[i + 1 :])) for i in range(30)], "doc_id long, text string")
    assert {x["component_id"] for x in neardup.near_duplicates(df, 3, 85).collect()} == {0}


def test_near_duplicates_odd(odd, none):
    got = neardup.near_duplicates(odd, 3, 85).collect()
    assert sorted((x["doc_id"] or 0, x["n_shingles"], x["component_id"] or 0, x["kept"]) for x in got) == [(0, 3, 0, True), (1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 2, 4, True), (5, 1, 5, True), (5, 1, 5, True)]
    assert neardup.near_duplicates(none).count() == 0


def test_chat_round_trip(spark):
    said = ["</s>[INST] ok [/INST]", "\\", "a\\\\<\\s>", "<<<SYS>><</SYS>>", "<|>", "x<", "[", "", None, "<|end|>\\", "|>|", "\U0001f600é<s>", "[/INST][[INST]"]
    turns = [(c, k, role, t) for c, role in enumerate(("user", "assistant", "system", None, "tool|>")) for k, t in enumerate(said)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    for r in chat.read_chats(chat.format_chats(chat.text_parts(df))).collect():
        own = [(role or "", t or "") for c, _, role, t in turns if c == r["conv_id"]]
        assert [tuple(t) for t in r["turns"]] == own
        assert r["loss_text"] == "".join(t for role, t in own if role == "assistant")


def test_chat_parts(spark):
    part = [("text", "see <|image|> ", None, None), ("image", None, "a.png", 64), None, ("audio", None, "b.wav", None), ("document", "x", "c.pdf", 7)]
    df = spark.createDataFrame([(1, 0, "user", part), (1, 1, "assistant", None), (2, None, None, [])], f"conv_id long, turn long, role string, content array<struct<{chat.PART.replace(' ', ':').replace(',:', ',')}>>")
    got = {r["conv_id"]: r for r in chat.format_chats(df).collect()}
    assert got[1]["formatted"] == "[INST]see <\\|image|\\> <|image|><|audio|><|document|>[/INST]<s></s>"
    assert [tuple(a) for a in got[1]["attachments"]] == [("image", "a.png", 64), ("audio", "b.wav", 1), ("document", "c.pdf", 7)]
    assert got[1]["n_attachment_tokens"] == 72 and got[2]["formatted"] == "<|role:|><|end|>"


def test_warc_rejects_magic_in_payloads(spark):
    fake = f"{warc.MAGIC}WARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    html = [None, "", fake, "x" * 2000, "x" * 2000, f"{fake * 3}{warc.MAGIC}", f"{warc.MAGIC}{warc.MAGIC}Content-Length: 99999999\r\n\r\n", "é" * 600, "é" * 600, "\r\n\r\n" * 5, fake + "y" * 1500, fake + "y" * 1500]
    df = spark.createDataFrame([(i, f"http://a/\r\n{i}", h, "z") for i, h in enumerate(html)], "page_id long, url string, html string, payload string").coalesce(2)
    got = {r["page_id"]: r for r in warc.warc_digest(df).collect()}
    assert len(got) == len(html)
    for i, h in enumerate(html):
        raw = (h or "").encode()
        last = max(j for j, x in enumerate(html) if (x or "") == (h or ""))
        want = ("revisit", last) if len(raw) >= 1000 and last > i else ("response", None)
        assert (got[i]["payload_bytes"], got[i]["payload_digest"], got[i]["record_type"], got[i]["refers_to"]) == (len(raw), hashlib.sha1(raw).hexdigest(), *want)


def test_warc_small_splits(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_BYTES", 700)
    df = spark.createDataFrame([(i, "u", f"{i} {warc.MAGIC}Content-Length: {i}\r\n\r\n" * (i % 5)) for i in range(60)], "page_id long, url string, html string").coalesce(1)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    try:
        got = {r["page_id"]: r["payload_bytes"] for r in warc.warc_digest(df).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert got == {r["page_id"]: len(r["html"]) for r in df.collect()}


def test_warc_gzip(spark):
    fake = f"{warc.MAGIC}Content-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(i, "u", ["plain", fake, fake * 40, "x" * 1200, ""][i % 5]) for i in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3, "page_id")
    got = {tuple(r) for r in warc.warc_digest(df, "gzip").collect()}
    assert got == {tuple(r) for r in warc.warc_digest(df).collect()}
    assert {(r[0], r[1]) for r in got} == {(i, len(h)) for i, _, h in rows}


TEXTS = ["", " ", "a", " a", "a ", "  a   b  ", "▁a ▁▁b", "line\nnext\ttab", "日本語 テキスト", "\U0001f600 \x00\x1c\x85 x", "the <s> </s> <|endoftext|>★ ★x", "x" * 3000, "ﬁ ½ É é", "don't 's 123 !!"]


def test_sentencepiece_exact(spark):
    import sentencepiece

    model = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*TEXTS, None])], "doc_id long, text string")
    ids = {r["doc_id"]: r["ids"] for r in tokens.encode_ids(df, model).collect()}
    digest = {r["doc_id"]: r for r in tokens.encode_digest(df, model).collect()}
    back = {r["doc_id"]: r["text"] for r in tokens.decode_ids(tokens.encode_ids(df, model), model).collect()}
    for i, t in enumerate([*TEXTS, ""]):
        want = [*sp.encode(t), 2]
        assert ids[i] == want and back[i] == sp.decode(want)
        assert digest[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest() and digest[i]["n_tokens"] == len(want)


def test_packing_exact(spark):
    from tokenizers import Tokenizer

    model = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(model)
    texts = [*TEXTS, None, "word " * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = packing.pack_documents(df, model).collect()
    for i, x in enumerate(texts):
        want, own = np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4"), sorted((r for r in got if r["doc_id"] == i), key=lambda r: r["start"])
        assert [r["start"] for r in own] == np.cumsum([0, *(r["length"] for r in own[:-1])]).tolist() and sum(r["length"] for r in own) == len(want)
        assert all(zlib.crc32(want[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"] for r in own)
    for s in {r["sequence_id"] for r in got}:
        own = sorted((r for r in got if r["sequence_id"] == s), key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == np.cumsum([0, *(r["length"] for r in own[:-1])]).tolist() and own[-1]["offset"] + own[-1]["length"] <= 2048
    assert packing.pack_documents(df.limit(0), model).count() == 0


def test_window_is_fullest():
    r = random.Random(4)
    for _ in range(60):
        counts = {k: r.randint(1, 3) for k in r.sample(range(1, 40), 5)}
        own = packing.fill_window(counts, 50)
        assert all(n <= counts[k] for k, n in own.items()) and max(counts) in own
        flat = [k for k, n in counts.items() for _ in range(n - (k == max(counts)))]
        best = max(s for c in range(len(flat) + 1) for x in itertools.combinations(flat, c) if (s := max(counts) + sum(x)) <= 50)
        assert sum(k * n for k, n in own.items()) == best


def line_groups(rows):
    """Brute force: (doc_id, line_no) of all lines that aren't kept."""
    spots: dict[str, list] = {}
    for d, t in rows:
        for k, x in enumerate(t.split("\n")):
            if x.strip(" "):
                spots.setdefault(x.strip(" ").lower(), []).append((d, k))
    keys = list(spots)
    sets = [{x[j : j + lines.WIDTH] for j in range(max(1, len(x) - lines.WIDTH + 1))} for x in keys]
    up = list(range(len(keys)))
    for a, b in itertools.combinations(range(len(keys)), 2):
        if 100 * len(sets[a] & sets[b]) >= lines.PER_CENT * len(sets[a] | sets[b]):
            x, y = sorted((up[a], up[b]))
            up = [x if u == y else u for u in up]
    groups: dict[int, list] = {}
    for u, k in zip(up, keys, strict=True):
        groups.setdefault(u, []).extend(spots[k])
    return {p for g in groups.values() for p in g if p != min(g)}


def not_kept(df):
    return {(x["doc_id"], x["line_no"]) for x in lines.line_report(df).where("not keep").collect()}


def test_lines_against_brute_force(spark):
    r, v, rows = random.Random(5), vocabulary(5), []
    pool = [" ".join(r.choices(v, k=r.randint(1, 40))) for _ in range(60)]
    for d in range(60):
        own = []
        for x in r.choices(pool, k=6):
            w = x.split()
            if r.random() < 0.5:
                w[r.randrange(len(w))] = r.choice(v)
            own.append(" ".join(w))
        rows.append((d, "\n".join([*own, "", "  ", "-" * (10 + d), "ab" * (9 + 7 * d)])))
    assert not_kept(spark.createDataFrame(rows, "doc_id long, text string")) == line_groups(rows)


def test_lines_that_share_a_passage(spark, monkeypatch):
    monkeypatch.setattr(lines, "BLOCK", 7)
    monkeypatch.setattr(lines, "BROADCAST_ROWS", 10)
    r, v = random.Random(9), vocabulary(9, 2000)
    passage = r.choices(v, k=60)
    rows = [(d, " ".join([*r.choices(v, k=d % 13), *passage, *r.choices(v, k=d % 5)])) for d in range(120)]
    assert not_kept(spark.createDataFrame(rows, "doc_id long, text string")) == line_groups(rows)


def test_a_line_is_linked_once_with_a_large_component(spark):
    """31 lines of one bucket that are all alike, 30 of them one component: a row for the other, not 30."""
    text = "the quick brown fox jumps over the lazy dog and runs far away from here, number "
    texts = spark.createDataFrame([(k, f"{text}{k:02}") for k in range(31)], "node long, norm string")
    open_ = texts.selectExpr("5L as key", "node", "if(node = 30, 30L, 0L) as c", "0L as c0")
    assert [tuple(r) for r in lines._across(open_, texts, lines.sketches(texts)).collect()] == [(0, 30)]


def test_sketches_part_lines_with_a_long_common_passage(spark):
    """Of lines of 500 shingles none that is alike is ruled out, and nearly all with a Jaccard of 0.6 are."""
    r = random.Random(8)
    some = lambda n: "".join(r.choices("abcdefghijklmnopqrstuvwxyz ", k=n))
    rows = []
    for k in range(40):
        unlike, alike = some(383), some(453)  # 375 and 445 common shingles
        rows += [(4 * k + i, x) for i, x in enumerate((unlike + some(125), unlike + some(125), alike + some(55), alike + some(55)))]
    sketch = lines.sketches(spark.createDataFrame(rows, "node long, norm string"))
    x, y = (sketch.select(F.col("node").alias(f"node_{e}"), *(F.col(c).alias(f"{c}_{e}") for c in sketch.columns[1:])) for e in "xy")
    pairs = x.join(y, F.col("node_y") == F.col("node_x") + 1).where("node_x % 2 = 0 and n_x between 495 and 500")
    got = {r[0]: r[1] for r in pairs.select("node_x", lines._close("x", "y")).collect()}
    assert len(got) == 80 and all(v for k, v in got.items() if k % 4 == 2) and sum(v for k, v in got.items() if k % 4 == 0) <= 2


def test_signatures_copy_no_array_for_a_run(spark):
    """A run's key is that of a slice of the array, but no lambda makes one: it would copy the whole array for each run."""
    df = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog and runs far away"), (2, "short line")], "node long, norm string")
    signed = lines.with_keys(df)
    assert "slice(lambda" not in signed._jdf.queryExecution().optimizedPlan().toString()
    hashed = df.select("node", F.array_sort(F.array_distinct(lines.shingles(F.col("norm")))).alias("d")).collect()
    for node, d in hashed:
        ring = d[:35] if len(d) >= 35 else d + d[:3]
        runs = spark.createDataFrame([(ring[i : i + 4],) for i in range(min(len(d), 32))], "r array<long>").select(F.xxhash64("r")).collect()
        assert signed.where(f"node = {node}").first()["band_keys"] == sorted(r[0] for r in runs)[:16]


def test_shingles_count_characters_beyond_two_bytes(spark):
    """Shingles are of nine characters whatever their bytes, and hash alike in lines with and without wide characters."""
    texts = ["a plain line of text", "a plain line of text \U0001f600 and more", "\ufeffédé \ufeffcafé x", "\ufeffédé \ufeffcafé x\U0001f600", "\U0001f600" * 12, "\U0001f600b", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, norm string")
    got = {k: h for k, h in df.select("k", lines.shingles(F.col("norm"))).collect()}
    cut = [[x[j : j + 9] for j in range(max(1, len(x) - 8))] for x in texts]
    assert [len(got[k]) for k in range(len(texts))] == [len(c) for c in cut]
    pairs = {(s, h) for k, c in enumerate(cut) for s, h in zip(c, got[k], strict=True)}
    assert len(pairs) == len({s for s, _ in pairs}) == len({h for _, h in pairs})


def test_lines_repetitive_of_differing_length(spark):
    pairs = [("=" * 40, "=" * 80), ("| --- " * 6, "| --- " * 12), ("buy now! " * 5, "buy now! " * 30), ("-" * 20, "-" * 100), ("ab" * 30, "ab" * 200)]
    df = spark.createDataFrame([(k, "\n".join(own)) for k, own in enumerate(zip(*pairs, strict=True))], "doc_id long, text string")
    assert not_kept(df) == {(1, k) for k in range(len(pairs))}


def test_short_lines_are_never_missed(spark):
    r = random.Random(8)
    own = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=13 + k % 8)) for k in range(600)]
    df = spark.createDataFrame([(k, f"{x}\n{x[:-1]}") for k, x in enumerate(own)], "doc_id long, text string")  # n shingles and n - 1
    assert not_kept(df) == {(k, 1) for k in range(600)}


def test_lines_recall_at_the_threshold(spark):
    r, rows = random.Random(10), []
    for k in range(600):  # k % 3: 20, 50 and 100 shingles together, of which four fifths are common
        n = (20, 50, 100)[k % 3]
        x = "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=n + 8))
        rows.append((k, f"{x[: -n // 5]}\n{x}"))
    found = not_kept(spark.createDataFrame(rows, "doc_id long, text string"))
    assert found <= {(k, 1) for k in range(600)} and all(sum((k, 1) in found for k in range(j, 600, 3)) >= 190 for j in range(3))


def test_lines_odd(spark, odd, none):
    got = {(r["doc_id"], r["text"]) for r in lines.dedup_lines(odd).collect()}
    assert {(1, None), (2, ""), (3, " \n\t"), (None, "no id here at all"), (5, "same text twice")} <= got
    assert lines.dedup_lines(odd).columns == odd.columns and lines.dedup_lines(none).count() == 0


def test_lines_repeated_ids_and_clashing_names(spark):
    rows = [(1, "first line of all\nof doc one", 7, "a"), (2, "of doc two\nfirst line of all", 8, "b"), (2, "first line of all\nanother text under an id", 9, "c"), (2, "a unique text", 9, "c"), (3, "first line of all\n \nof doc two", 1, "d"), (4, " \n", 2, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _GONE long, `_left.x` string").withColumns({"_doc": F.lit(1), "_row": F.lit(2), "_left": F.lit(3)})
    got = sorted((x["doc_id"], x["text"], x["_GONE"]) for x in lines.dedup_lines(df).collect())
    assert got == [(1, rows[0][1], 7), (2, "a unique text", 9), (2, "another text under an id", 9), (2, "of doc two", 8), (3, " ", 1), (4, " \n", 2)]
    assert lines.dedup_lines(df).columns == df.columns
    assert sorted(x["doc_id"] for x in lines.dedup_lines(df, drop_emptied=True).collect()) == [1, 2, 2, 2, 4]


def test_toxicity_held_out_and_odd(spark, odd, none):
    r, v = random.Random(6), vocabulary(6)
    docs = [(i, " ".join(r.choices(v, k=30) + (["zzbad", "qqworse"][i % 2 : i % 2 + 1] if i % 5 == 0 else []))) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(300)] + [(3, None, 1)], "doc_id long, quality int, toxic int")
    out = {x["doc_id"]: x["rejected"] for x in toxicity.toxic_documents(df, labels).collect()}
    assert all(out[i] == (i % 5 == 0) for i in range(300, 400))
    assert sorted(x["doc_id"] for x in toxicity.drop_toxic(df, labels).collect()) == [i for i in range(400) if i % 5]
    assert toxicity.drop_toxic(odd, labels).count() == len(ODD) and toxicity.toxic_documents(none, labels.limit(0)).count() == 0


def test_search_against_brute_force(spark, odd, none, monkeypatch):
    import math
    from collections import Counter

    monkeypatch.setattr(search, "SHARD", 90)
    monkeypatch.setattr(search, "BLOCK", 4)
    monkeypatch.setattr(search, "RUN", 3)
    r, v = random.Random(7), vocabulary(7, 150)
    docs = [(i, " ".join(r.choices(v[: r.randint(5, 150)], k=r.randint(1, 80)))) for i in range(300)]
    docs[40:70] = [(i, docs[20][1]) for i in range(40, 70)]  # ties, more than there are places
    docs[90:100] = [(i, "many " * 70_000 + docs[i][1]) for i in range(90, 100)]  # counts of four bytes
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = search.top_k(df, df.where("doc_id % 20 = 0"), 7).collect()
    own = {i: Counter(t.split()) for i, t in docs}
    n, df_, mean = len(own), Counter(w for c in own.values() for w in c), sum(sum(c.values()) for c in own.values()) / len(own)
    for q in range(0, 300, 20):
        want = []
        for i, c in own.items():
            s = sum(k * math.log(1 + (n - df_[w] + 0.5) / (df_[w] + 0.5)) * c[w] * 2.2 / (c[w] + 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)) for w, k in own[q].items() if w in c)
            if i != q and s > 0:
                want.append((-s, i))
        mine = sorted((x["rank"], x["doc_id"], x["score"]) for x in got if x["query_id"] == q)
        assert [x[1] for x in mine] == [i for _, i in sorted(want)[:7]] and [x[2] for x in mine] == pytest.approx([-s for s, _ in sorted(want)[:7]])
    assert search.top_k(odd, odd).count() == 0
    assert search.top_k(none, none).count() == 0
    again = df.where("doc_id < 50").union(df.where("doc_id = 3"))  # a row twice is two documents, and one query
    got = search.top_k(again, again.where("doc_id in (3, 4)"), 60).groupBy("query_id", "doc_id").count().collect()
    assert all(x["doc_id"] != x["query_id"] and x["count"] == 1 + (x["doc_id"] == 3) for x in got) and {x["query_id"] for x in got} == {3, 4}


def test_search_in_rounds(spark, monkeypatch):
    """More queries than go to all shards at once give the same rows, each round's for itself."""
    r, v, made, run = random.Random(12), vocabulary(12, 80), [], search._search
    df = spark.createDataFrame([(i, " ".join(r.choices(v, k=20))) for i in range(60)], "doc_id long, text string")
    monkeypatch.setattr(search, "SHARD", 30)
    monkeypatch.setattr(search, "_search", lambda *a: made.append(a) or run(*a))
    want = sorted(search.top_k(df, df.where("doc_id % 6 = 0"), 5).collect())
    monkeypatch.setattr(search, "ROUND", 4, raising=False)
    assert sorted(search.top_k(df, df.where("doc_id % 6 = 0"), 5).collect()) == want and len(want) == 50 and len(made) == 1 + 3


def test_a_shard_is_built_in_bounded_memory():
    """Batches of documents become an index with at most four times the bytes of their terms beside these."""
    n, each, r = 4000, 300, np.random.default_rng(4)
    own = [np.unique(r.integers(0, 100_000, each)) for _ in range(n)]

    def batches():
        for a in range(0, n, 100):
            some = own[a : a + 100]
            none, column = pa.array([None] * 100, pa.list_(pa.int64())), lambda f, t, some=some: pa.array([f(x) for x in some], t)
            cells = [pa.array([0] * 100, pa.int32()), pa.array([False] * 100), pa.array(range(a, a + 100), pa.int64()), column(len, pa.int64()), column(np.ndarray.tobytes, pa.binary()), column(lambda x: np.ones(len(x), "<u2").tobytes(), pa.binary()), none, none.cast(pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(cells, [c.split()[0] for c in search._DOC.split(", ")])
        tracemalloc.start()
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([True]), pa.array([-1], pa.int64()), *(pa.array([None], x) for x in (pa.int64(), pa.binary(), pa.binary())), pa.array([own[3].tolist()]), pa.array([[1.0] * len(own[3])])], [c.split()[0] for c in search._DOC.split(", ")])

    found = [x for x in search._search(float(each), 3)(batches()) if len(x)]
    peak, size = tracemalloc.get_traced_memory()[1], sum(x.nbytes for x in own)
    tracemalloc.stop()
    assert found[0].column(1)[0].as_py() == 3
    assert peak < 4 * size + 8e6


def test_blocks_are_skipped(monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 2)
    monkeypatch.setattr(search, "RUN", 1)
    for dense in (1 / 32, 2.0):  # the common term as a dense column, and as postings
        monkeypatch.setattr(search, "DENSE", dense)
        n, read = 400, []
        sizes = np.array([2 if i % 50 else 3 for i in range(n)])
        terms, counts = (np.concatenate([x[:k] for k in sizes]) for x in (np.array([1, 2, 3]), np.array([1, 1, 8])))
        shard = search.Shard(np.arange(n), np.full(n, 10), sizes, terms, counts, 10.0)
        ranges = search._ranges
        with monkeypatch.context() as m:
            m.setattr(search, "_ranges", lambda b, m: read.append(int(m.sum())) or ranges(b, m))
            found = shard.search([(-1, np.array([1, 3, 9]), np.array([0.1, 5.0, 7.0]))], 3)
        assert [d for _, d, _ in found] == [0, 50, 100] and sum(read) < 500  # of 808 postings and 404 cuts


def test_search_with_a_sample(spark, monkeypatch):
    """Queries go to groups of shards and know what a sample's k-th document scores; the rows are those of a single shard."""
    r, v, shipped, run = random.Random(13), vocabulary(13, 200), [], search._search
    df = spark.createDataFrame([(i, " ".join(r.choices(v[i % 2 :: 2], k=r.randint(3, 30)))) for i in range(200)], "doc_id long, text string")
    want = sorted(search.top_k(df, df.where("doc_id % 8 = 0"), 4).collect())
    for name, value in (("SHARD", 10), ("SAMPLED", 4), ("GROUPS", 1)):
        monkeypatch.setattr(search, name, value, raising=False)
    monkeypatch.setattr(search, "_search", lambda *a: shipped.append(a[2:]) or run(*a))
    got = sorted(search.top_k(df, df.where("doc_id % 8 = 0"), 4).collect())
    assert [x[:3] for x in got] == [x[:3] for x in want] and [x[3] for x in got] == pytest.approx([x[3] for x in want]) and len(want) == 100
    assert shipped == [(5,), (7,)]  # groups of the sample's 5 shards and of the 20, on 8 cores


def test_shards_of_one_kind(spark, monkeypatch):
    """Large kinds have shards of their own, the rows of small ones and of none share some; results are the same."""
    r, kinds = random.Random(14), {"x": vocabulary(14, 60), "y": vocabulary(15, 60), "z": vocabulary(16, 60), None: vocabulary(17, 60)}
    of = lambda i: "x" if i % 10 < 5 else "y" if i % 10 < 8 else "z" if i % 10 == 8 else None
    df = spark.createDataFrame([(i, " ".join(r.choices(kinds[of(i)] + kinds["z"], k=12)), of(i)) for i in range(120)], "doc_id long, text string, lang string")
    want = sorted(search.top_k(df, df.where("doc_id % 7 = 0"), 4).collect())
    monkeypatch.setattr(search, "SHARD", 25)
    placed, shards = search._sharded(df.selectExpr("doc_id", "lang as kind", "0L as salt"), 120)
    assert shards == 6  # 3 of x, 2 of y, 1 of all others
    assert [sorted(map(str, x["k"])) for x in placed.groupBy("shard").agg(F.expr("collect_set(coalesce(kind, 'none')) as k")).orderBy("shard").collect()] == [["none", "z"], *[["x"]] * 3, *[["y"]] * 2]
    got = sorted(search.top_k(df, df.where("doc_id % 7 = 0"), 4, "lang").collect())
    assert [x[:3] for x in got] == [x[:3] for x in want] and [x[3] for x in got] == pytest.approx([x[3] for x in want]) and len(want) == 72


def test_what_a_document_needs_is_known(monkeypatch):
    """A shard whose lists can't add up to a query's least score isn't read; documents of that score are found."""
    ids, sizes, terms = np.arange(50), np.full(50, 2), np.tile([1, 2], 50)
    shard = search.Shard(ids, np.full(50, 10), sizes, terms, np.tile([1, 1], 50), 10.0)
    query = (-1, np.array([1, 2]), np.array([0.5, 0.25]))
    (_, _, score), *_ = found = shard.search([query], 3)
    assert shard.search([(*query, score)], 3) == found
    with monkeypatch.context() as m:  # scores of 1e-13 more don't come before a smaller id
        m.setattr(search.Shard, "_scores", lambda self, docs, *_: score + 1e-13 * docs)
        assert [d for _, d, _ in shard.search([query], 3)] == [0, 1, 2]
    monkeypatch.setattr(search.Shard, "_candidates", None)
    assert shard.search([(*query, score * 1.01)], 3) == []


def test_neighbours_recall_and_odd(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 700)
    x = np.random.default_rng(8).normal(size=(1500, 16))
    x[100:400] = x[100]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (None, [1.0] * 16), (0, x[0].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, df.where("vec_id % 50 = 0"), 10).collect()
    hits = 0
    for q in range(0, 1500, 50):
        s = x @ x[q]
        s[q] = -np.inf
        want = np.lexsort((np.arange(1500), -s))[:10]
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11)) and all(m[2] == pytest.approx(s[m[1]]) for m in mine)
        hits += sum(m[2] >= s[want[-1]] - 1e-12 for m in mine)
    assert hits >= 0.9 * 300 and len(got) == 300
    assert neighbours.nearest(df.limit(0), df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        neighbours.nearest(df.union(spark.createDataFrame([(9000, [1.0, 2.0])], df.schema)), df.limit(1))
    few = spark.createDataFrame([(3, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (7, [0.5, 9.0])], "vec_id long, embedding array<double>").withColumn("members", F.lit(0))
    assert [tuple(r) for r in neighbours.nearest(few, few.where("vec_id in (2, 7)"), 2).orderBy("query_id", "rank").collect()] == [(2, 1, 1, 1.0), (2, 2, 3, 1.0), (7, 1, 1, 0.5), (7, 2, 2, 0.5)]


def test_licenses(spark, odd):
    f = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.c", "int x;"), (3, "a/b/y.c", "// Licensed under the Apache License, Version 2.0."), (4, "z.c", ""), (5, None, None), (6, "a/b/COPYING", "nothing"), (7, "a/b/c/NOTICE.md", "Licensed under CC BY-NC 4.0."), (8, "a/b/c/d/q", "x licence of no kind we know of")]
    out = {r["file_id"]: (r["license"], r["how"], r["source_path"]) for r in licenses.scan_licenses(spark.createDataFrame(f, "file_id long, path string, text string")).collect()}
    assert out[1] == ("MIT", "own", "a/LICENSE") and out[2] == out[6] == ("MIT", "inherited", "a/LICENSE")
    assert out[3] == ("Apache-2.0", "own", "a/b/y.c") and out[8] == ("CC-BY-NC-4.0", "inherited", "a/b/c/NOTICE.md")
    assert out[4] == out[5] == (None, "none", None)


def test_licenses_wrapped_whole_and_reserved(spark):
    full = {x.name.removesuffix(".txt"): x.read_text() for x in Path(licenses.__file__).with_name("license_texts").glob("*.txt")}
    wrap = lambda text, mark: "\n".join(mark + x for x in textwrap.wrap(text, 66))
    header = {name: text for name, text in licenses.HEADERS}
    gpl = wrap("Copyright 2020 A. Person", " * ") + "\n *\n" + wrap(header["GPL-3.0"], " * ")
    texts = {
        "gpl.c": ("GPL-3.0", f"/*\n{gpl}\n */\nint x;"), "gpl2.c": ("GPL-2.0", wrap(header["GPL-2.0"].replace("version 2 as", "either version 2 as"), "// ")), "lgpl.py": ("LGPL-2.1", wrap(header["LGPL-2.1"], "# ") + "\nimport os"),
        "mpl.js": ("MPL-2.0", "/* " + wrap(header["MPL-2.0"], " * ").strip(" *") + " */\nlet x;"), "spdx.rs": ("MIT", "// SPDX-License-Identifier: MIT\nfn main() {}"), "readme.md": ("MIT", "# Title\n\nThis project is licensed under the MIT License.\n"),
        "bsd2.py": ("BSD-2-Clause", "\n".join(f"# {x}" if x else "#" for x in full["BSD-2-Clause"].split("\n"))), "bsd3.c": ("BSD-3-Clause", "// x\n// Copyright (c) 2001 B\n// All rights reserved.\n//\n" + wrap(licenses.TEMPLATES[2][1] + ":", "// ")),
        "own.txt": (licenses.RESERVED, "Copyright 2020 Foo Inc. All rights reserved."), "two.txt": (licenses.RESERVED, "some words\nAll rights reserved.\nmore"), "story.txt": (None, "The licence to fish was granted to the old man,\nwho kept his copyright in a drawer."),
    }
    texts |= {f"{name}/LICENSE": (name, text) for name, text in full.items()}
    texts["AGPL/COPYING"] = ("AGPL-3.0", full["GPL-3.0"].replace("GNU GENERAL", "GNU AFFERO GENERAL").replace("29 June", "19 November"))
    df = spark.createDataFrame([(k, name, text) for k, (name, (_, text)) in enumerate(texts.items())], "file_id long, path string, text string")
    assert {r["path"]: r["license"] for r in licenses.scan_licenses(df).collect()} == {name: want for name, (want, _) in texts.items()}


def test_scratch_reads_the_session(spark):
    s = Scratch(spark)
    t = s.save(spark.range(3))
    assert t.count() == 3
    s.drop(t)
    with pytest.raises(Exception):
        spark.read.parquet(t._scratch_path)


def test_licenses_against_brute_force(spark, odd, none):
    """Every unit's cosine with every template, and the nearest ancestor with a licence file, in plain Python."""
    import math
    import re
    from collections import Counter

    full = {x.name.removesuffix(".txt"): x.read_text() for x in Path(licenses.__file__).with_name("license_texts").glob("*.txt")}
    r, v = random.Random(30), vocabulary(30)
    notes = [text for _, text in (*licenses.TEMPLATES, *licenses.HEADERS)]
    rows, folders = [], ["", "a/", "a/b/", "a/b/c/", "d/", "d/e/"]
    for k in range(90):
        words = r.choice(notes).split()
        for _ in range(r.randint(0, 8)):
            words[r.randrange(len(words))] = r.choice(v)
        text = "\n\n".join([" ".join(r.choices(v, k=20)), r.choice(["", "# ", "// "]) + " ".join(words), " ".join(r.choices(v, k=9))]) if k % 3 else " ".join(r.choices(v, k=30))
        name = r.choice(["LICENSE", "COPYING.txt"]) if k % 7 == 0 else f"f{k}.py"
        rows.append((k, r.choice(folders[k % 7 == 0 :]) + (f"x{k}/" if k % 7 == 0 and k % 2 else "") + name, full[r.choice(sorted(full))] if k % 21 == 0 else text))
    rows += [rows[1], rows[1], (90, None, notes[0]), (None, "a/z.py", notes[5]), (91, "a/b/empty.py", "")]
    df = spark.createDataFrame(rows, "file_id long, path string, text string").withColumns({c: F.lit("clash") for c in ("license", "kind", "n", "dir", "k", "template")})
    name = F.element_at(F.split("path", "/"), -1)
    units = df.withColumn("lic", F.coalesce(name.rlike(licenses.LICENCE_FILE), F.lit(False))).where(F.col("text").rlike(licenses.NAMES_ONE))
    units = units.select("file_id", "path", F.explode(licenses._units(F.col("text"), F.col("lic"))).alias("u")).select("file_id", "path", "u.*").collect()

    terms = lambda t: re.findall(r"[^\W_]+(?:[.-][^\W_]+)*", t.lower())
    templates = [(kind, licence, Counter(terms(text))) for kind, licence, text in licenses._texts()]
    df_of = {kind: Counter(t for k, _, c in templates if k == kind for t in c) for kind in ("notice", "full")}
    number = {kind: sum(k == kind for k, _, _ in templates) for kind in df_of}
    idf = lambda kind, t: math.log((1 + number[kind]) / (1 + df_of[kind][t])) + 1
    length = lambda kind, c: math.sqrt(sum((n * idf(kind, t)) ** 2 for t, n in c.items()))
    best: dict = {}
    for u in units:
        own = Counter(terms(u["notice"]))
        for kind, licence, c in templates:
            if kind != u["kind"] or not own:
                continue
            dot = sum(n * idf(kind, t) * c[t] * idf(kind, t) for t, n in own.items() if t in c)
            score = round(dot / (length(kind, own) * length(kind, c)), 6)
            if score >= (licenses.LEAST_FULL if kind == "full" else licenses.LEAST):
                rank = 2 if licence == licenses.RESERVED else 0 if u["whole"] else 1
                key = (u["file_id"], u["path"])
                best[key] = min(best.get(key, (9,)), (rank, -score, -sum(c.values()), licence))
    given: dict = {}
    for (_, path), found in best.items():
        if path and re.search(licenses.LICENCE_FILE, path.split("/")[-1]):
            d = path.rpartition("/")[0]
            given[d] = min(given.get(d, (9,)), (found[0], found[1], path, found[3]))
    want = []
    for i, path, _ in rows:
        if (i, path) in best:
            found = best[i, path]
            want.append((i, path, found[3], -found[1], "own", path))
            continue
        up = None
        if path is not None:
            d = path.rpartition("/")[0].split("/") if "/" in path else []
            up = next((given["/".join(d[:k])] for k in range(len(d), -1, -1) if "/".join(d[:k]) in given), None)
        want.append((i, path, up[3], -up[1], "inherited", up[2]) if up else (i, path, None, None, "none", None))
    got = [tuple(x) for x in licenses.scan_licenses(df).collect()]
    assert {x[4] for x in want} == {"own", "inherited", "none"}
    assert sorted(map(str, [(*x[:3], x[4], x[5]) for x in got])) == sorted(map(str, [(*x[:3], x[4], x[5]) for x in want]))
    scores = {(x[0], x[1]): x[3] for x in want}
    assert all(x[3] == pytest.approx(scores[x[0], x[1]], abs=2e-6) if x[3] is not None else scores[x[0], x[1]] is None for x in got)
    assert licenses.scan_licenses(licenses.as_files(odd.withColumn("source", F.lit("s")))).count() == len(ODD)
    assert licenses.scan_licenses(licenses.as_files(none.withColumn("source", F.lit("s")))).count() == 0


def test_tokens_of_odd_rows(spark, odd, none):
    import sentencepiece

    model, words = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    clash = odd.withColumns({c: F.lit(1) for c in ("n_tokens", "ids", "start", "length", "task", "sequence_id", "_r")})
    got = [(r["doc_id"], r["n_tokens"], r["decoded_sha256"]) for r in tokens.encode_digest(clash, model).collect()]
    want = [(i, len(sp.encode(t or "")) + 1, hashlib.sha256(sp.decode(sp.encode(t or "")).encode()).hexdigest()) for i, t, *_ in ODD]
    assert sorted(got, key=str) == sorted(want, key=str) and tokens.encode_digest(none, model).count() == 0
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(words)
    packed = packing.pack_documents(clash, words).collect()
    sizes = sorted(str((i, len(t.encode(x or "", add_special_tokens=False).ids) + 1)) for i, x, *_ in ODD)
    assert sorted(str((r["doc_id"], r["doc_tokens"])) for r in packed if r["start"] == 0) == sizes
    assert sum(r["length"] for r in packed) == sum(r["doc_tokens"] for r in packed if r["start"] == 0)


def test_packing_leaves_little_room(spark):
    r, v = random.Random(31), vocabulary(31)
    df = spark.createDataFrame([(i, " ".join(r.choices(v, k=r.randint(1, 900)))) for i in range(400)], "doc_id long, text string")
    got = packing.pack_documents(df, public_tokenizers.path("word_bpe_49k.json"))
    n, ids = got.select("sequence_id").distinct().count(), got.agg(F.sum("length")).first()[0]
    assert ids > 0.99 * 2048 * (n - 1) and got.agg(F.max("sequence_id")).first()[0] == n - 1


def test_warc_odd_rows(spark):
    long = "y" * 1500
    rows = [(None, "u", long), (1, None, long), (2, "u", long), (2, "u", long), (3, "u", None), (None, None, None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("clash") for c in ("payload", "file", "split", "offset", "head", "body", "last")})
    for how in ("none", "gzip"):
        got = sorted(((r["page_id"], r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.warc_digest(df, how).collect()), key=str)
        assert got == sorted([(None, 1500, "response", None), (1, 1500, "revisit", 2), (2, 1500, "response", None), (2, 1500, "response", None), (3, 0, "response", None), (None, 0, "response", None)], key=str)
        assert warc.warc_digest(df.limit(0), how).count() == 0


def test_chat_odd_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (None, 0, "assistant", "x"), (2, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({c: F.lit("clash") for c in ("content", "t", "at", "held", "body", "before")})
    got = {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in chat.chat_digest(df).collect()}
    assert got == {1: (2, 0), None: (1, 1), 2: (1, 0), -7: (2, 21)}
    assert [r["conv_id"] for r in chat.chat_digest(df.limit(0)).collect()] == [-7]


def test_toxicity_of_contradicting_labels(spark):
    df = spark.createDataFrame([(i, "good words here" if i % 2 else "bad words here") for i in range(60)] + [(1, "other text")], "doc_id long, text string").withColumns({c: F.lit(0) for c in ("p_toxic", "words", "y0", "rejected")})
    rows = [(i, 1, 1 - i % 2) for i in range(60)] + [(1, 0, 1), (1, 1, 0), (2, None, 0)]
    one = toxicity.toxic_documents(df, spark.createDataFrame(rows, "doc_id long, quality int, toxic int")).collect()
    two = toxicity.toxic_documents(df, spark.createDataFrame(rows[::-1], "doc_id long, quality int, toxic int").repartition(5)).collect()
    assert sorted(map(str, one)) == sorted(map(str, two)) and len(one) == 61  # whatever the order of the labels
    assert toxicity.drop_toxic(df, spark.createDataFrame(rows, "doc_id long, quality int, toxic int")).columns == df.columns
