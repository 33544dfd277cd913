"""Tables with odd rows: nulls, empty and long texts, ties, repeated rows, clashing names."""

CLASH = ["id", "t", "th", "n", "row", "data", "source", "size", "lines", "a", "b", "rank"]


def documents(spark, rows):
    """rows: (doc_id, text, source); with further columns whose names operators may use themselves."""
    extra = [c for c in CLASH if c != "source"]
    full = [(i, t, s, *(f"x{k}" for k in range(len(extra)))) for i, t, s in rows]
    return spark.createDataFrame(full, "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in extra))


def odd_rows(long_words=20000):
    long_ = " ".join(f"w{i}" for i in range(long_words))
    return [(1, None, "a"), (2, "", "a"), (None, "only text", None), (4, long_, "b"), (5, long_, "b"), (5, long_, "b"), (6, " \t\n ", None), (7, "tie tie tie", "a"), (8, "tie tie tie", "a")]


def kept(df):
    """The extra columns come through untouched."""
    r = df.select("t", "th", "row").where("t is not null").first()
    return r is None or tuple(r) == ("x1", "x2", "x4")
