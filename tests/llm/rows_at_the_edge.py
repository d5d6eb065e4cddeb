"""Rows every operator has to cope with: nulls, empty, long and repeated texts, clashing names."""

LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
CLASHES = (
    "key tie line text2 doc rate score n token_ids decoded secrets n_words rank list id a b label _x "
    "_words _found _longest _id _score _rate _copy _decoded _key _label _domain given found longest copy rate_key gone"
).split()


def edge_rows(spark):
    texts = ["", None, " \t\n", "one", "one", "a b c d e f g", LONG, "x" * 3_000, "Ünïcödé 日本 \U0001f600 end", "l\n\nl\n"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, "a b c d e f g"), (5, "another text"), (None, "no id"), (None, None)]
    return wide(spark, rows)


def wide(spark, rows):
    """(doc_id, text) with columns of the names operators use for themselves."""
    schema = "doc_id bigint, text string, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, *(["own"] * len(CLASHES))) for r in rows], schema)


def narrow(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")
