"""Periodic runs, benchmark passages and conversation repair against brute force."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache

import numpy as np
import pytest
from corpus import frame, words
from pyspark.sql import functions as F

from quarrymill.llm import conversations, decontamination, periodic_runs, queries

SMALL = "/root/testdata/sf0.001"


def sha(t: str) -> str:
    return hashlib.sha256(t.encode()).hexdigest()


# ---- periodic runs


def brute_runs(w: list) -> list[tuple[int, int, int]]:
    """(start, length, period) by definition: for each period the maximal stretches, least period only."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_collapse(w: list[str], runs) -> str:
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def periodic_texts(seed: int) -> list[str | None]:
    rng = random.Random(seed)
    out: list[str | None] = [None, "", " \n", "a", "a a a a a", "a a a a a a", "a b a b a b a", "a b a b a b a b", "  é\x0bé é é é é  "]
    for _ in range(40):
        w = []
        while len(w) < rng.choice([30, 200, 900]):
            q = rng.choice([1, 2, 3, 5, 8, 9, 10, 13, 14, 20, 21, 33, 34, 60])
            base = [rng.choice("ab" if rng.random() < 0.4 else "abcdefgh") for _ in range(q)]
            w += (base * 9)[: rng.randint(q, 7 * q)]
            w += [f"w{rng.randint(0, 9)}" for _ in range(rng.randint(0, 5))]
        out.append(" ".join(w))
    out += [" ".join(["aaa"] * 300), " ".join((["a"] * 9 + ["b"]) * 30), " ".join(rng.choice("ab") for _ in range(2000))]
    return out


def test_runs_equal_the_definition(spark):
    texts = periodic_texts(5)
    rows = {r["doc_id"]: r for r in periodic_runs.collapse_runs(frame(spark, texts)).collect()}
    for i, t in enumerate(texts):
        want = brute_runs(words(t))
        assert [(r["start"], r["length"], r["period"]) for r in rows[i]["runs"]] == want, t
        assert rows[i]["n_words"] == len(words(t)) and rows[i]["collapsed"] == brute_collapse(words(t), want)


def test_scales_alone_find_all_runs_that_lags_find():
    rng = random.Random(1)
    w = [rng.choice("ab") for _ in range(4000)]
    for q in (3, 7, 50, 77, 118, 119, 200):
        at = rng.randint(0, 3000)
        w[at : at + 4 * q] = (w[at : at + q] * 4)[: len(w) - at]
    number = np.unique(w, return_inverse=True)[1]
    rows = np.zeros(len(w), np.int64)
    scaled = periodic_runs.find_runs(number, rows, 1, short=2)
    lagged = periodic_runs.find_runs(number, rows, 1, short=1000)
    assert all((a == b).all() for a, b in zip(scaled, lagged, strict=True)) and len(scaled[0]) > 5


def test_strongest_run_takes_the_first_of_equal_exponents(spark):
    texts = ["a a a a a a a a x b c b c b c b c b c b c b c b c", "x " + "a b " * 4 + "y " + "c d e " * 4, "a b c"]
    got = periodic_runs.collapse_runs(frame(spark, texts)).select("doc_id", periodic_runs.strongest_run(F.col("runs")).alias("b")).orderBy("doc_id").collect()
    assert [tuple(r["b"]) if r["b"] else None for r in got] == [(0, 8, 1), (1, 8, 2), None]


def test_runs_query_plants_and_finds_by_its_contract(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, SMALL).collect()}
    planted = 0
    for doc_id, text in docs:
        w = words(text)
        n, h = len(w), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = brute_runs(w) if n < 3000 else None
        r = got[doc_id]
        if runs is None:
            continue
        best = max(runs, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=None)
        assert (r["n_runs"], r["start"], r["length"], r["period"]) == (len(runs), *(best or (None,) * 3))
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        assert r["runs_sha256"] == sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)) and r["collapsed_sha256"] == sha(brute_collapse(w, runs))
    assert planted > 5 and len(got) == len(docs)


def test_runs_stand_odd_rows(spark):
    assert periodic_runs.collapse_runs(frame(spark, [])).count() == 0
    twice = periodic_runs.collapse_runs(frame(spark, ["a " * 9, "a " * 9, None], [1, 1, None])).collect()
    assert sorted((r["doc_id"] or 0, len(r["runs"])) for r in twice) == [(0, 0), (1, 1), (1, 1)]
    long = " ".join(f"w{i % 5000}" for i in range(40_000))
    (one,) = periodic_runs.collapse_runs(frame(spark, [long])).collect()
    assert [tuple(r) for r in one["runs"]] == [(0, 40_000, 5000)] and len(one["collapsed"].split(" ")) == 5000
    odd = periodic_runs.with_planted_runs(frame(spark, ["a b c", None, ""], [None, 3, 4])).collect()
    assert sorted((r["text"] is None, r["text"] or "") for r in odd) == [(False, ""), (False, "a b c"), (True, "")]


# ---- benchmark passages


def leak_words(t: str | None) -> list[str]:
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_leaks(text: str | None, items: list[tuple]) -> tuple:
    w = leak_words(text)
    hit, names = set(), set()
    for name, t in items:
        v = leak_words(t)
        k = min(10, len(v))
        for j in range(len(v) - k + 1) if k else ():
            for i in range(len(w) - k + 1):
                if w[i : i + k] == v[j : j + k]:
                    hit |= set(range(i, i + k))
                    names.add("" if name is None else str(name))
    return len(w), len(hit), sorted(names)


@pytest.mark.parametrize("limit", [decontamination.BROADCAST_BYTES, -1])
def test_leaks_equal_the_definition(spark, limit):
    rng = random.Random(2)
    vocabulary = [f"{a}{b}" for a in ("Éa", "be", "ÇU", "ΣΑΣ", "x9") for b in "KLmn"]
    say = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", " -", "\n"]) for _ in range(n))
    items = [(k, say(n)) for k, n in enumerate([25, 12, 10, 9, 4, 3, 2, 1, 40, 11])] + [(None, say(14)), (20, None), (21, ""), (22, " .,!"), (8, say(13)), (30, "a b a b a b a b a b a b a b")]
    items[7] = (7, "onlyword")
    texts = [None, "", "...", "onlyword", "nothing here"]
    for _ in range(60):
        t = [say(rng.randint(0, 20))]
        for _ in range(rng.randint(0, 3)):
            v = (rng.choice(items)[1] or "").split(" ")
            a = rng.randint(0, max(0, len(v) - 5))
            t += [" ".join(v[a : a + rng.randint(5, 30)]).swapcase() if rng.random() < 0.3 else " ".join(v[a : a + rng.randint(5, 30)]), say(rng.randint(0, 6))]
        texts.append(" ; ".join(t))
    texts += [texts[9], "a b " * 9]
    ids = [*range(len(texts) - 2), 9, None]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("w", F.lit("x"))
    got = decontamination.benchmark_overlap(frame(spark, texts, ids), bench, broadcast_bytes=limit).collect()
    want = [(i, *brute_leaks(t, items)) for i, t in zip(ids, texts, strict=True)]
    order = lambda r: (r[0] is None, r[0] or 0)
    assert sorted([(r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got], key=order) == sorted(want, key=order)
    assert sum(bool(x[3]) for x in want) > 20


def test_leaks_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontamination.benchmark_overlap(frame(spark, ["a b", None]), none).orderBy("doc_id").collect()
    assert [(r["n_words"], r["n_hit"], r["items"]) for r in got] == [(2, 0, []), (0, 0, [])]
    assert decontamination.benchmark_overlap(frame(spark, []), none).count() == 0


def test_leaks_query_equals_sql(spark):
    from compare import differences, duck

    name = "op12_benchmark_decontamination"
    assert differences(queries.QUERIES[name](spark, SMALL).toPandas(), duck(SMALL).sql(queries.ORACLES[name]).df()) == []


# ---- conversations

BLANK = " \t\n\x0b\x0c\r"


def damage(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))


def brute_repair(rows: list[tuple]) -> tuple:
    faults, seen = [], set()
    for _, role, text in rows:
        t = text.strip(BLANK)
        faults.append("blank" if not t else "duplicate" if (role, text) in seen else "truncated" if t[-1] not in ".!?" else "")
        seen.add((role, text))
    start, moves = "", {"": "su", "s": "u", "u": "a", "a": "u"}

    @lru_cache(maxsize=None)
    def best(i: int, state: str, budget: int) -> tuple:
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []

        def add(cost, letter, at, to, line, left=budget):
            c, a, t = best(at, to, left)
            ways.append((cost + c, letter + a, (line, *t) if line is not None else t))

        if budget:
            for r in ("user", "assistant"):
                if r[0] in moves[state]:
                    add(5, "I", i, r[0], f"{r}:", budget - 1)
        if i < len(rows):
            _, role, text = rows[i]
            add(2, "D", i + 1, state, None, 2)
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                if role[:1] in moves[state] and role:
                    add(more, "K", i + 1, role[0], f"{role}:{text}", 2)
                for r in ("user", "assistant"):
                    if r[0] in moves[state]:
                        add(1 + more, "R", i + 1, r[0], f"{r}:{text}", 2)
        return min(ways, key=lambda w: w[:2], default=(10**9, "", ()))

    cost, audit, lines = best(0, start, 2)
    turns = [r[0] for r in rows if r[0] is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, "\n".join(lines)


def some_conversations(seed: int, n: int) -> list[tuple]:
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "ok", "And then", "", " \t", None, "Why?\n", "é…", "One. Two"]
    roles = ["user", "assistant", "system", "tool", None, "", "User", "a", "s"]
    rows = []
    for conv in [*range(n), None]:
        tidy = rng.random() < 0.5
        for t in range(rng.choice([1, 2, 3, 6, 9, 14])):
            role = ("user", "assistant")[t % 2] if tidy and rng.random() < 0.9 else rng.choice(roles)
            turn = rng.choice([t, t, t, t + 1, None]) if not tidy else t
            rows.append((conv, turn, role, rng.choice(texts) if rng.random() < 0.4 else f"text {rng.randint(0, 999)}."))
    rows += rows[3:9]
    return rows


@pytest.mark.parametrize("parts", [2, 60])
def test_repairs_equal_brute_force(spark, parts):
    rows = some_conversations(4, 70)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = conversations.repair_conversations(conversations.with_damage(table), copies_col="copies", parts=parts).collect()
    convs = {r[0] for r in rows}
    assert len(got) == len(convs)
    for r in got:
        want = brute_repair(damage([x for x in rows if x[0] == r["conv_id"]]))
        assert tuple(r)[1:] == want, r["conv_id"]


def test_a_conversation_that_ranges_cut_gets_the_same_repair(spark):
    sys.setrecursionlimit(10_000)  # for the brute force
    rng = random.Random(9)
    rows = [(7, t, rng.choice(["user", "assistant", "assistant", "user", "tool"]), f"t{rng.randint(0, 60)}" + rng.choice([".", ".", "?", ""])) for t in range(400)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole, cut = (conversations.repair_conversations(table, parts=p).collect() for p in (1, 40))
    assert whole == cut
    assert tuple(whole[0])[1:] == brute_repair(sorted((t, r, x) for _, t, r, x in rows))


def test_search_equals_dynamic_programming():
    rng = random.Random(3)
    for _ in range(300):
        codes = bytes(rng.choice([0, 1, 1, 2, 2, 3, 1 | 4, 2 | 4, 1 | 8, 2 | 8]) for _ in range(rng.randint(0, 25)))
        table = conversations.through(codes)
        search = conversations.Search(codes)
        assert all(min(a + b for a, b in zip(table[4 * q : 4 * q + 4], conversations.ENDS, strict=True)) == search.from_state(q)[0] for q in range(4))


def test_repairs_stand_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, conv int, rows int"
    assert conversations.repair_conversations(spark.createDataFrame([], schema)).count() == 0
    gone = spark.createDataFrame([(5, 1, "user", "x", 0, 0)], schema).withColumn("copies", F.lit(0))
    assert [tuple(r) for r in conversations.repair_conversations(gone, copies_col="copies").collect()] == [(5, 0, 0, 0, 0, 0, 0, "", "")]
    many = spark.createDataFrame([(None, None, "user", "Hi.", 0, 0)], schema).crossJoin(spark.range(3000))
    (r,) = conversations.repair_conversations(many).collect()
    assert (r["conv_id"], r["duplicate"], r["illegal"], r["cost"], len(r["audit"]), r["repaired"]) == (None, 2999, 2999, 6000, 3000, "")


def test_repair_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    by: dict = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, SMALL).collect()}
    for conv, own in by.items():
        *want, text = brute_repair(damage(own))
        assert got[conv] == (*want, sha(text))
    assert len(got) == len(by)
