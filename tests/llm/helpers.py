"""Small tables with the awkward cases: nulls, empty and long texts, repeated rows, clashing extra columns."""

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, block int, id long, prints string"


def long_text(seed: int, words: int = 3000) -> str:
    return " ".join(f"w{(seed * 7919 + i * 104729) % 1000003}" for i in range(words))


def texts() -> list[tuple[int | None, str | None]]:
    passage = " ".join(f"shared{i}" for i in range(60))
    base = [f"tok{i}" for i in range(200)]
    edited = base.copy()
    edited[100] = "other"
    return [
        (1, " ".join(base)),
        (2, " ".join(edited)),
        (3, " ".join(base)),
        (3, " ".join(base)),
        (4, f"start of four {passage} end of four"),
        (5, f"another start {passage}\nand another end"),
        (6, ""),
        (7, None),
        (8, " \t\n "),
        (9, "short text"),
        (10, "short text"),
        (11, long_text(1)),
        (12, long_text(2, 20000)),
        (13, "Ünïcode ÉTÉ straße ñandú " * 3 + "日本語 \U0001f600"),
        (None, " ".join(base)),
        (None, None),
    ]


def docs(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 2, "x") for i, t in rows], DOC_SCHEMA)
