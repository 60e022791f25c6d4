"""Small documents with every awkward case, as (doc_id, text, lang, source, n_chars) and clashing extra columns."""

import random

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices("abcdeé", k=rng.randint(1, 6))) for _ in range(n)]


def documents(seed: int = 1, size: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    base = words(rng, 80)
    texts = [None, "", "   \n\t", "one", "Two Words", "a b c d", "A B C D", " ".join(base), "x" * 5000, " ".join(words(rng, 6000))]
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = "new" + str(rng.randint(0, 99))
        texts.append(" ".join(w).upper() if rng.random() < 0.2 else " ".join(w))
    texts += [" ".join(words(rng, rng.randint(1, 60))) for _ in range(size // 2)]
    texts += texts[5:15]
    rows = [(i, t, "en" if i % 3 else None, f"src{i % 4}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    rows.append((None, texts[7], None, None, None))
    rows.append(rows[12])  # a row that occurs twice
    rng.shuffle(rows)
    return rows


def frame(spark, rows, extra: bool = True):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(2)
    if extra:
        df = df.selectExpr("*", "'x' as rk", "1 as kept", "'y' as row", "2L as q", "'z' as group_size", "3 as key__", "'w' as node", "'v' as digest")
    return stable(df)


def stable(df):
    """Written and read again: operators that read twice need a stable scan."""
    import tempfile

    path = tempfile.mkdtemp()
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def empty(spark):
    return stable(spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long"))
