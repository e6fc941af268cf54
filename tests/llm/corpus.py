"""A small corpus with the cases that operators must stand: nulls, empty and long texts, copies, near copies."""

from __future__ import annotations

import random
import re

WORDS = "the of and river stone bright window carries morning letter garden seven quiet harbour silver under thousand old market bread".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, size int, tag string, _id long, copies int, score double, n_words int"


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "", str(rng.randint(0, 99))]) for _ in range(n)) + "."


def texts(seed: int = 3, n: int = 60) -> list[str | None]:
    rng = random.Random(seed)
    out: list[str | None] = [None, "", " ", "\n\n\t", "one", "two words", "é ß 日本語 ﬁ", "a" * 300, "x " * 400, "\x00 odd \x0b bytes"]
    base = [sentence(rng, rng.randint(20, 160)) for _ in range(n)]
    out += base + base[:5] + base[:2]  # copies
    for t in base[5:15]:  # near copies
        w = t.split()
        w[len(w) // 2] = "changed"
        out.append(" ".join(w))
    shared = sentence(rng, 25)
    out += [f"{sentence(rng, 30)} {shared} {sentence(rng, 30)}" for _ in range(8)]
    out += [f"{sentence(rng, 60)} AKIA{''.join(rng.choice('ABCDEFGH234567') for _ in range(16))} {sentence(rng, 8)} password={rng.getrandbits(72):018x}" for _ in range(12)]
    out.append("\n".join([sentence(rng, 9)] * 40))
    out.append(" ".join(sentence(rng, 50) for _ in range(120)))  # a long text
    return out


def frame(spark, values: list[str | None] | None = None, ids: list[int | None] | None = None):
    values = texts() if values is None else values
    ids = list(range(len(values))) if ids is None else ids
    rows = [(i, t, ("en", "de", None)[k % 3], ("hot" if k % 3 else f"s{k % 5}") if k % 11 else None, len(t) if t is not None else None, "k", 1, "t", 5, 9, 0.5, 3) for k, (i, t) in enumerate(zip(ids, values, strict=True))]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def words(t: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")
