"""Small tables with the awkward cases every operator must handle."""

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows, extra=None):
    """rows: (doc_id, text). extra: DDL of columns whose names clash with the operators' own, filled with 7."""
    full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
    if extra:
        names = [c.strip() for c in extra.split(",")]
        return spark.createDataFrame([(*r, *[7] * len(names)) for r in full],
                                     DOC + ", " + ", ".join(f"{n} long" for n in names))
    return spark.createDataFrame(full, DOC)


def save(df, folder, name):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def awkward(long_words=30_000):
    """Rows with NULL ids and texts, empty and very long texts, ties and repeated rows."""
    return [(None, None), (1, None), (2, ""), (3, "  \n "), (4, "um dois"), (4, "um dois"), (5, "um dois"),
            (6, "palavra longa " * long_words), (7, "ä ß 中文 \u2028 x\x00y"), (None, "sem id")]
