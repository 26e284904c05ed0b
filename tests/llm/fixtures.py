"""Small corpora with copies, near copies, shared passages, secrets and odd rows."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
EMPTY = [None, "", "   ", "\n\n", "one", "one two", "é", "\x0b\x0c"]


def corpus(seed: int = 7, size: int = 90) -> list[tuple]:
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzäöé") for _ in range(r.randint(2, 9))) for _ in range(400)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage, other = prose(60), prose(40)
    texts = list(EMPTY)
    while len(texts) < size:
        kind = r.randrange(9)
        if kind == 0 and len(texts) > 20:
            texts.append(r.choice([t for t in texts if t]))
        elif kind in (1, 2):
            base = r.choice([t for t in texts if t]).split(" ")
            for _ in range(r.randint(0, max(1, len(base) // 12))):
                base[r.randrange(len(base))] = r.choice(words)
            texts.append(" ".join(base))
        elif kind == 3:
            texts.append(f"{prose(r.randint(3, 50))} {passage}\n{prose(5)} {r.choice([other, other.upper(), ''])}")
        elif kind == 4:
            line = prose(6)
            texts.append("\n".join(r.choice([line, prose(4), "# * $ <x>", "", " "]) for _ in range(12)))
        elif kind == 5:
            key = "".join(r.choice("0123456789abcdef") for _ in range(r.choice([12, 24, 40])))
            secret = r.choice([f'api_key = "{key}"', f"PASSWORD:{key[:6]}", "AKIA" + key.upper(), f"toKen=>{key}", key, f"x password= secret: {key}"])
            texts.append(f"{prose(20)} {secret} {prose(30)} {secret}é{secret}")
        else:
            texts.append(prose(r.choice([5, 60, 120, 300, 1500])))
    texts.append("ab " * 700)
    r.shuffle(texts)
    ids = r.sample(range(10 * size), len(texts))
    return [(i, t, r.choice(["en", "de", None]), r.choice(["web", "code", None]), len(t or "")) for i, t in zip(ids, texts, strict=True)]


def frame(spark, rows: list[tuple]):
    """Documents, with further columns whose names clash with those the operators make."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(5)
    for name in ("id", "path", "kept", "n", "spans", "blob", "ids", "did", "piece", "component_id", "n_words", "sig"):
        docs = docs.withColumn(name, F.lit("x"))
    return docs
