import random

EXTRA = "did string, th string, key string, n string, ids string, range string, place string, h string, fp string"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
WORDS = "river stone quiet morning paper window garden little answer letter silver winter".split()


def prose(seed: int, words: int = 90) -> str:
    r = random.Random(seed)
    made = [r.choice(WORDS) + r.choice(["", "s", "ing", "ly", "er"]) for _ in range(words)]
    for i in range(11, words, 12):
        made[i] += "."
    return " ".join(made) + "."


def frame(spark, rows):
    """Rows of (doc_id, text, source), with columns whose names clash with internal ones."""
    full = [(i, t, "en", s, None if t is None else len(t), *["x"] * 9) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)
