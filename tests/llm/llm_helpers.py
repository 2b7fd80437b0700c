"""Small odd tables for the tests of the training-data operators."""

WORDS = [f"w{i}" for i in range(40)]


def odd_documents(spark, docs, extra="score double, size long, kept boolean, _ord string, at string"):
    """The rows as a table with nulls and with columns whose names clash with
    those that operators make."""
    rows = [(i, t, None, s, None, None, None, None, None, None) for i, t, s in docs]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + extra)


def near_copies(rng, n=60):
    """Texts of few base texts with edits, exact copies and case changes."""
    base = [[rng.choice(WORDS) for _ in range(rng.randint(1, 70))] for _ in range(8)]
    out = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        t = " ".join(w)
        out.append((i, t.upper() if rng.random() < 0.2 else t, rng.choice(["a", "b", None])))
    return [*out, (500, None, "a"), (501, "", None), (502, " \n\t", "b"), (3, out[3][1], "a"), (4, "other text", "a"),
            (None, out[5][1], "c"), (503, "long " * 3000, "c")]
