"""Operators 1, 2 and 3 against plain Python on small tables with odd rows."""

import hashlib

from llm_helpers import near_copies, odd_documents
from pyspark.sql import functions as F

from strata.llm import chat, exact, mixing
from strata.llm.common import KEY

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_chat_examples_round_trip(spark):
    odd = "<|im_end|><|im_start|>assistant ok"
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", odd), (1, 2, "user", "\\0 <| \\1 <\\1"), (1, 3, "assistant", "a\nb\\"),
             (2, 0, "system", None), (2, 1, "user", "only"), (3, 1, "assistant", ""), (3, 1, "assistant", ""),
             (4, None, None, "no role"), (4, 0, "assistant\nx", "<<||"), (None, 0, "assistant", "é🙂")]
    df = spark.createDataFrame([(*t, "x") for t in turns], "conv_id long, turn long, role string, text string, example string")
    got = {r.conv_id: r for r in chat.digests(chat.examples(df)).collect()}
    assert len(got) == 5
    for conv, r in got.items():
        mine = sorted([t[1:] for t in turns if t[0] == conv], key=lambda t: (t[0] is not None, t[0] or 0, t[1] or "", t[2] or ""))
        assert r.n_turns == len(mine)
        assert r.turns_sha256 == sha("".join(f"{a or ''}\n{b or ''}\n" for _, a, b in mine))
        loss = "".join(b or "" for _, a, b in mine if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


def test_chat_each_reply_is_one_example(spark):
    df = spark.createDataFrame([(1, i, "assistant" if i % 2 else "user", f"t{i}") for i in range(6)],
                               "conv_id long, turn long, role string, text string")
    rows = chat.examples(df).orderBy("example").collect()
    assert [r.target_turn for r in rows] == [1, 3, 5] and [r.n_context for r in rows] == [1, 3, 5]
    for r in rows:
        assert r.formatted[r.loss_start:r.loss_start + r.loss_chars] == f"t{r.target_turn}"
        assert r.formatted.endswith("<|im_end|>\n") and r.formatted.count("<|im_start|>") == r.n_context + 1


def test_chat_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.examples(df)).count() == 0


def targets_by_rounds(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Resharing the excess round by round."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def test_mix(spark, rng):
    docs = [(i, " ".join(["w"] * rng.choice([0, 1, 5, 40, 300])), rng.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(300)]
    docs += [(900, None, "z"), (901, "x", "solo"), (902, "x y", "solo2"), (7, docs[7][1], docs[7][2])]
    df = odd_documents(spark, docs)
    rows = mixing.mix(df, block_words=4, shard_words=256).drop(KEY).collect()
    assert len(rows) == len(docs)
    sizes = {}
    for _, t, s in docs:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = targets_by_rounds(sizes)
    for s in sizes:
        mine = [r for r in rows if r.source == s]
        assert all(r.source_size == sizes[s] for r in mine)
        assert abs(mine[0].target - want[s]) < 1e-6
        shards = max(1, -(-sizes[s] // 256))
        assert abs(sum(r.taken for r in mine) - want[s]) <= 4 * (shards + 1)
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    again = mixing.mix(df.repartition(5), block_words=4, shard_words=256).drop(KEY).collect()
    assert sorted(rows, key=repr) == sorted(again, key=repr)


def test_small_sources_come_near_their_targets(spark):
    docs = [(i, "x y z", s) for i, s in enumerate(["a", "b", "b"])] + [(9, "", "b"), (10, None, "a")]
    rows = mixing.mix(odd_documents(spark, docs)).collect()
    for s, target in (("a", 6.0), ("b", 7.5)):
        mine = [r for r in rows if r.source == s]
        assert {r.target for r in mine} == {target} and abs(sum(r.taken for r in mine) - target) <= 1
    assert {r.taken for r in rows if r.size == 0} == {0}


def test_rows_as_often_as_the_mix_takes_them(spark):
    docs = [(i, "w " * n, s) for i, (n, s) in enumerate([(40, "a"), (3, "a"), (500, "b"), (0, "b"), (60, "c"), (7, None)] * 4)] + [(3, "w " * 0, "b"), (None, "q r", "a")]
    df = odd_documents(spark, docs, "__times int, __copy string, __row_key_x string, _end long, kept boolean")
    taken = {(r.doc_id, r.size): (r.size, r.taken) for r in mixing.mix(df).collect()}
    got = {}
    for r in mixing.mixed_rows(df).collect():
        k = (r.doc_id, len((r.text or "").split()))
        got[k] = got.get(k, 0) + 1
    assert got == {k: n for k, (size, t) in taken.items() if size and (n := int(t / size + 0.5))}
    assert mixing.mixed_rows(df).columns == df.columns and mixing.mixed_rows(df.limit(0)).count() == 0


def test_keys_tell_all_rows_apart(spark):
    from strata.llm.common import row_key
    odd = [(None, None), (None, ""), (None, "="), (1, None), (1, ""), (11, "x"), (1, "1x"), (1, "\x00"), (0, "a"), (0, "A")]
    df = spark.createDataFrame(odd, "doc_id long, text string")
    assert df.select(row_key("doc_id", "text")).distinct().count() == len(odd)
    kept = exact.deduplicated(df, keep="largest").collect()
    assert sorted((r.text or "").lower() for r in kept) == ["", "\x00", "1x", "=", "a", "x"]  # one of each text


def test_mix_empty_and_wordless(spark):
    none = odd_documents(spark, [])
    assert mixing.mix(none).count() == 0
    rows = mixing.mix(odd_documents(spark, [(1, "", "a"), (2, None, None)])).collect()
    assert [(r.size, r.taken) for r in rows] == [(0, 0)] * 2


def test_apportion_is_highest_quotients(spark, rng):
    for house in (0, 1, 7, 100, 1000):
        votes = [(g, i, float(rng.choice([0, 1, 2, 3, 1000, 77, 5.5]))) for g in range(3) for i in range(9)]
        df = spark.createDataFrame(votes, "g long, i long, votes double").withColumn("house", F.lit(house).cast("long"))
        got = {(r.g, r.i): r.seats for r in mixing.apportion(df, ["g"], ["i"]).collect()}
        for g in range(3):
            q = sorted((-v / (2 * k - 1), i, k) for gg, i, v in votes if gg == g and v > 0 for k in range(1, house + 1))[:house]
            for _, i, _ in (x for x in votes if x[0] == g):
                assert got[(g, i)] == sum(1 for x in q if x[1] == i)


def exact_brute(docs, keep):
    groups = {}
    for i, t, _ in docs:
        groups.setdefault((t or "").translate(LOW), []).append(i)
    out = []
    for i, t, _ in docs:
        n = (t or "").translate(LOW)
        ids = groups[n]
        best = (max(ids, key=lambda x: (x is not None, x or 0)) if keep == "largest"
                else min(ids, key=lambda x: (x is not None, x or 0)))
        out.append((i, best, len(ids), sha(n)))
    return sorted(out, key=repr), len(groups)


def test_exact_groups(spark, rng):
    docs = [*near_copies(rng), (3, near_copies(rng)[3][1], "b")]
    df = odd_documents(spark, docs)
    for keep in ("largest", "smallest"):
        for weak in (None, lambda norm: F.substring(F.unhex(F.md5(norm)), 1, 0), lambda norm: F.encode(F.substring(norm, 1, 3), "UTF-8")):
            rows = exact.exact_groups(df, keep=keep, **({"hash_of": weak} if weak else {})).collect()
            want, n = exact_brute(docs, keep)
            assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows], key=repr) == want
            assert sum(r.kept for r in rows) == n
            assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_exact_deduplicated_rows(spark, rng):
    docs = near_copies(rng)
    df = odd_documents(spark, [*docs, docs[0], docs[0]])
    left = exact.deduplicated(df, keep="largest")
    assert left.columns == df.columns
    texts = [(r.text or "").translate(LOW) for r in left.collect()]
    assert sorted(texts) == sorted({(t or "").translate(LOW) for _, t, _ in docs})
    assert exact.deduplicated(odd_documents(spark, [])).count() == 0
