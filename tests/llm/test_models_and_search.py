"""Operators 5, 7, 9 and 10, the pipeline and the registered queries."""

import math

import numpy as np
import pytest
from llm_helpers import near_copies, odd_documents
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm import pieces, quality, token_counts, topk
from strata.llm.common import stored
from strata.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_quality_held_out_accuracy(spark):
    rows = QUERIES["op5_quality_classifier"](spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    got = rows.filter("held_out").select("score", "predicted", "quality").collect()
    assert len(got) > 20 and sum(r.predicted == r.quality for r in got) / len(got) > 0.9
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    again = QUERIES["op5_quality_classifier"](spark, SF).collect()
    assert sorted(again) == sorted(QUERIES["op5_quality_classifier"](spark, SF).collect())


def test_quality_learns_from_the_right_rows_only(spark):
    docs = odd_documents(spark, [(i, ("good words here " if i % 2 else "BAD!! BAD!! ") * 20, "a") for i in range(60)])
    labels = spark.range(60).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.trained(docs, x) for x in (labels, flipped))
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_quality_odd_rows(spark, rng):
    df = odd_documents(spark, near_copies(rng))
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.classified(df, none).collect()
    assert len(rows) == df.count() and all(r.score == 0.5 for r in rows)
    assert quality.classified(df.limit(0), none).count() == 0
    long = "word and more text.\n" * 200_000  # read in parts
    import pyarrow as pa
    whole = quality._tally(*quality.text_bytes(pa.array([long])))
    parts = quality.tallies(pa.array([long]))
    assert whole[0, 0] == parts[0, 0] and whole[0, 229] == parts[0, 229] and np.allclose(whole[0, 1:129], parts[0, 1:129])


@pytest.fixture(scope="module")
def encoder():
    return pieces.Encoder(pieces.model_path())


def best_score(e, text):
    s = " " + text
    best = [0.0] + [-math.inf] * len(s)
    for i in range(len(s)):
        single = False
        for n in range(1, e.max_piece + 1):
            w = s[i:i + n]
            if len(w) == n and pieces.SPACE not in w and (p := e.pieces.get(w.replace(" ", pieces.SPACE))):
                single |= n == 1
                best[i + n] = max(best[i + n], best[i] + p[1])
        if not single:
            best[i + 1] = max(best[i + 1], best[i] + e.unknown)
    return best[-1]


def score_of(e, ids):
    gain, byte = {i: g for i, g in e.pieces.values()}, {i: b for b, i in enumerate(e.byte)}
    total, held = 0.0, b""
    for i in ids:
        if i not in byte:
            total += gain[i]
            continue
        held += bytes([byte[i]])
        try:
            held.decode()
        except UnicodeDecodeError:
            continue
        total, held = total + e.unknown, b""
    return total


def test_viterbi_is_best_and_streams(encoder, rng):
    for _ in range(500):
        text = "".join(rng.choice("abe th  \n▁é中x🙂ing") for _ in range(rng.randint(0, 60)))
        ids = np.frombuffer(encoder.encode(text), np.int32)
        assert encoder.decode(ids) == text
        if text:
            assert abs(score_of(encoder, ids.tolist()) - best_score(encoder, text)) < 1e-6
            assert b"".join(encoder.stream(" " + text)) == ids.tobytes()


def test_viterbi_commits_on_the_way(encoder):
    text = "internationalization" * 500  # one unit, longer than any window
    commits = list(encoder.stream(text[i:i + 64] for i in range(0, len(text), 64)))
    assert len(commits) > 20 and b"".join(commits) == b"".join(encoder.stream([text]))


def test_pieces_as_the_library_reads_them(encoder):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())
    for text in ("Hello  world\n x", "é 中文 🙂", "a"):
        assert sp.decode(np.frombuffer(encoder.encode(text), np.int32).tolist()) == text


def test_pieces_on_tables(spark, rng):
    df = odd_documents(spark, near_copies(rng)).withColumn("token_ids", F.lit("clash"))
    rows = pieces.decoded(pieces.encoded(df, check="ok")).collect()
    assert len(rows) == df.count() and all(r.ok and r.decoded == (r.text or "") for r in rows)
    assert all(r.round_trip for r in pieces.digests(df).collect())
    assert pieces.digests(df.limit(0)).count() == 0


def test_token_counts_equal_the_library(spark, rng):
    odd = ["<|endoftext|>", "a<|startoftext|>b", "don't", "́x", "\x1c", "\x00", "İΣς", "12", "  ", "\n", "é中🙂", "'s"]
    docs = [(i, "".join(rng.choice([*odd, "word ", "the", " "]) for _ in range(rng.randint(0, 50))), "a") for i in range(200)]
    df = odd_documents(spark, [*docs, *near_copies(rng)])
    c = token_counts.Counter(token_counts.vocabulary())
    rows = token_counts.token_counts(df, limit=20).collect()
    texts = {(i, len((t or "").encode())): c.encoded([t or ""])[0] for i, t, _ in [*docs, *near_copies(rng)]}
    assert all(r.over_limit == (r.n_tokens > 20) for r in rows)
    for r, (i, t) in zip(df.select("doc_id", "text").collect(), df.select("doc_id", "text").collect()):
        assert r.doc_id == i
    assert sorted((r.n_bytes, r.n_tokens) for r in rows) == sorted(
        (len((t or "").encode()), c.encoded([t or ""])[0]) for _, t in df.select("doc_id", "text").collect())
    assert texts and token_counts.token_counts(df.limit(0)).count() == 0


def test_prefix_counts_and_budgets(spark, rng):
    c = token_counts.Counter(token_counts.vocabulary())
    docs = [(i, " ".join("".join(rng.choice("abcdefgh'é") for _ in range(rng.randint(1, 9))) for _ in range(12)), "a") for i in range(30)]
    df = odd_documents(spark, docs)
    counts = token_counts.token_counts(df, at_words=True)
    for r, (_, text, _) in zip(counts.orderBy("doc_id").collect(), docs):
        ends, tokens = np.array(r.word_ends), np.array(r.prefix_tokens)
        for j in range(0, len(text) + 1, 3):
            upto = len(text[:j].encode())
            assert token_counts.prefix_count(text.encode(), ends, tokens, upto, c) == c.encoded([text[:j]])[0]
    for budget in (0, 3, 10, 1000):
        for r in token_counts.truncated(df, counts, budget).collect():
            text = docs[r.doc_id][1]
            fits = [j for j in range(len(text) + 1) if c.encoded([text[:j]])[0] <= budget]
            assert len(r.text) == max(fits)


def brute_top(rows, k):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in {(i, tuple(v)) for i, v in good if i % 5 == 0}:
        found = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i and len(v) == len(q))[:k]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(found, 1)]
    return sorted(out)


def test_top_k(spark, rng):
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(40)]  # equal vectors: ties to smaller ids
    rows += [(None, rows[0][1]), (400, None), (401, [1.0, None] + [0.0] * 6), (402, [float("nan")] * 8), (405, [float("inf")] * 8),
             (410, [1.0, 2.0]), (415, [0.0] * 8), (420, []), (7, rows[7][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, score long")
    for shard, block, leaf in ((8192, 4096, 64), (40, 10, 4)):
        got = topk.top_k(df, F.col("vec_id") % 5 == 0, shard_rows=shard, query_rows=block, leaf=leaf).collect()
        assert sorted(map(tuple, got)) == brute_top(rows, 10)
    assert topk.top_k(df.limit(0), F.col("vec_id") % 5 == 0).count() == 0


def test_top_k_beyond_doubles(spark):
    rows = [(i, [1e9 * (i + 1), -2e9, 3.5e9 + i]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 5 == 0).collect()))
    cap = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    assert {r[0] for r in got} == {0, 5, 10} and all(r[3] == cap(r[3]) for r in got)


def test_pipeline_stages(spark, rng):
    docs = odd_documents(spark, near_copies(rng, 40))
    for name, stage in corpus_pipeline.STAGES[1:]:
        out = stored(stage(spark, docs, SF), "stage-test")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            docs = out
        else:
            assert set(docs.columns) < set(out.columns) and all(r.round_trip for r in out.collect())
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_pipeline_over_documents(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "token_ids", "n_tokens"} <= set(got.columns) and got.filter("NOT round_trip").count() == 0
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert got.join(labels.filter("quality = 0"), "doc_id").count() <= 1
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 0 < got.select("doc_id").distinct().count() < docs.count()


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) - set(ORACLE) == {"op5_quality_classifier", "op7_sentencepiece", "op9_token_counts", "op11_embedding_whitening", "op13_personal_data"}
