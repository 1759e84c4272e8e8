"""Small frames and word rules shared by the tests."""

import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower(text):
    return (text or "").translate(LOWER)


def docs(spark, rows, extra=True):
    """rows: (doc_id, text) or (doc_id, text, source); with columns whose names clash with the operators' own."""
    rows = [(r[0], r[1], r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None, "x", 7.0) for r in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, score string, size double")
    return df if extra else df.select("doc_id", "text", "source", "n_chars")
