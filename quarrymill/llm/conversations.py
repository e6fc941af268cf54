"""Repair of the structure of conversations by iterative-deepening A*.

Turns are kept, get another role, are deleted, or turns are inserted, at the least cost after which
the roles are nothing, or pairs of user and assistant after at most one system turn. The search is
depth first, tries edits in the order of their initials (D, I, K, R) and gives up a path whose cost and
lower bound of the rest exceed the bound; the bound then rises to the least that was exceeded. A table
holds, for each place and state of the role pattern, the lower bound that failed searches have proven.
With the bound at the least cost the first path to the end is the answer.

A search doesn't need texts: rows of a conversation become one byte each, in order, in pieces that a
sort by range has dealt out, so a conversation of any length is many pieces. A piece that isn't a
conversation's last ends in the costs that the rest has from each state on; these are composed from
the pieces' own tables of costs from state to state.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import use_checkpoints

SPACES = " \t\n\x0b\x0c\r"
#: Costs of edits; an open (truncated) turn that stays costs OPEN more.
DELETE, INSERT, REROLE, OPEN = 2, 5, 1, 5
FAR = 1 << 40
# States of the pattern: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
# Role classes: 0 system, 1 user, 2 assistant, 3 other; NEXT[state][class] is the next state or -1.
NEXT = ((1, 2, -1, -1), (-1, 2, -1, -1), (-1, -1, 3, -1), (-1, 2, -1, -1))
STEP = (2, 2, 3, 2)  # where an inserted or rerolled turn leads
ENDS = (0, 2 * INSERT, INSERT, 0)  # insertions after the last row
LEGAL = frozenset({(0, 1), (1, 2), (2, 1)})
FORCED, UNFINISHED = 4, 8  # bits of a row's byte beside its class: must be deleted; is open


def _lower_bounds(codes: bytes) -> list[int]:
    """At each place, a cost that the rows from there on have at least.

    A row that must go, or an open one, costs a deletion; a row of another role costs a new role; of
    neighbours that stay and don't fit together one costs a new role, each row in one pair at most.
    """
    h = [0] * (len(codes) + 1)
    one = two = 0  # most pairs from the next live row on, and from the one after it
    last, fixed = -1, 0
    for i in range(len(codes) - 1, -1, -1):
        c = codes[i]
        if c & (FORCED | UNFINISHED):
            fixed += DELETE
        elif c == 3:
            fixed += REROLE
            one, two, last = one, one, -1
        else:
            pair = two + 1 if last >= 0 and (c, last) not in LEGAL else 0
            one, two = max(one, pair), one
            last = c
        h[i] = fixed + one * REROLE
    return h


class Search:
    """Cheapest repairs of a piece: codes of its rows, and what the rest costs from each state on."""

    def __init__(self, codes: bytes, ends: tuple[int, ...] = ENDS):
        self.codes, least = codes, min(ends)
        self.bounds = [[x + least] * 4 for x in _lower_bounds(codes)]
        self.bounds[len(codes)] = list(ends)

    def edits(self, i: int, q: int) -> list[tuple[int, int, int, str]]:
        """(cost, next place, next state, initial) of the edits at a place and state, in the order of initials."""
        c = self.codes[i]
        out = [(DELETE, i + 1, q, "D"), (INSERT, i, STEP[q], "I")]
        if not c & FORCED:
            more = OPEN if c & UNFINISHED else 0
            if (to := NEXT[q][c & 3]) >= 0:
                out.append((more, i + 1, to, "K"))
            out.append((REROLE + more, i + 1, STEP[q], "R"))
        return out

    def from_state(self, q: int) -> tuple[int, str, int]:
        """(cost with the rest's, initials, state at the end) of the first cheapest repair from state q on."""
        while True:
            bound = self.bounds[0][q]
            if bound >= FAR:
                return FAR, "", q
            if (found := self._within(q, bound)) is not None:
                return bound, *found

    def _within(self, q: int, bound: int) -> tuple[str, int] | None:
        """Depth first within the bound; where it fails, bounds[0][q] has risen above it."""
        bounds, n = self.bounds, len(self.codes)
        if n == 0:
            return "", q
        # a frame: place, state, what may still be spent, edits left, least bound seen below
        path: list[str] = []
        stack = [(0, q, bound, iter(self.edits(0, q)), [FAR])]
        while stack:
            i, s, rest, left, least = stack[-1]
            for cost, j, t, initial in left:
                need = cost + bounds[j][t]
                if need > rest:
                    if need < least[0]:
                        least[0] = need
                    continue
                path.append(initial)
                if j == n:
                    return "".join(path), t
                stack.append((j, t, rest - cost, iter(self.edits(j, t)), [FAR]))
                break
            else:
                stack.pop()
                if least[0] > bounds[i][s]:
                    bounds[i][s] = least[0]
                if stack:
                    path.pop()
                    up = stack[-1]
                    up[4][0] = min(up[4][0], up[2] - rest + bounds[i][s])
        return None


def through(codes: bytes) -> list[int]:
    """Least costs from each state before the rows to each state after them, as 16 numbers."""
    costs = [[FAR] * 4 for _ in range(4)]
    for q in range(4):
        costs[q][q] = 0
    for i in range(len(codes) - 1, -1, -1):
        c = codes[i]
        more = OPEN if c & UNFINISHED else 0
        after, costs = costs, []
        for q in range(4):
            ways = [[DELETE + x for x in after[q]]]
            if not c & FORCED:
                if (to := NEXT[q][c & 3]) >= 0:
                    ways.append([more + x for x in after[to]])
                ways.append([REROLE + more + x for x in after[STEP[q]]])
            costs.append([min(x) for x in zip(*ways, strict=True)])
        for _ in range(2):  # insertions before the row lead from state to state
            for q in range(4):
                costs[q] = [min(a, INSERT + b) for a, b in zip(costs[q], costs[STEP[q]], strict=True)]
    return [min(x, FAR) for row in costs for x in row]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (conv, part, code, copies) to pieces; only the first and last of a task may be cut."""
    done, now, codes, copies, part, first = [], None, bytearray(), [], 0, True

    def table(rows: list) -> pa.RecordBatch:
        convs, *rest = zip(*rows, strict=True)
        types = [pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.concat_arrays(convs), *(pa.array(c, t) for c, t in zip(rest, types, strict=True))], names=["id", "part", "codes", "copies", "through"])

    for b in batches:
        conv = b.column(0)
        if not len(conv):
            continue
        index = conv.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        edges = [0, *((index[1:] != index[:-1]).nonzero()[0] + 1).tolist(), len(index)]
        code, times, part = b.column(2).to_numpy(zero_copy_only=False), b.column(3).to_numpy(zero_copy_only=False), b.column(1)[0].as_py()
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            own = conv.slice(a, 1)
            if now is not None and now.to_pylist() != own.to_pylist():
                done.append((now, part, bytes(codes), copies, through(codes) if first else None))
                codes, copies, first = bytearray(), [], False
            now = own
            codes += code[a:z].astype("u1").tobytes()
            copies += times[a:z].tolist()
        if len(done) >= 1000:
            yield table(done)
            done = []
    if now is not None:
        done.append((now, part, bytes(codes), copies, through(codes)))
    if done:
        yield table(done)


WAY = "struct<cost:long,exit:int,audit:string,fates:array<int>>"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (conv, part, codes, copies, ends, leads) with the answer from each state that may come before them.

    fates: -1 for a row that goes, else twice the turns inserted before it, and 1 more for a new role.
    """
    known: dict = {}
    for b in batches:
        out = []
        for codes, copies, ends, leads in zip(*(b.column(k).to_pylist() for k in (2, 3, 4, 5)), strict=True):
            ways, key = [], (codes, tuple(ends), leads)
            answers = known.get(key)
            if answers is None:
                search = Search(codes, tuple(ends))
                answers = [search.from_state(q) if q == 0 or not leads else None for q in range(4)]
                if len(codes) <= 64:
                    if len(known) > 50_000:
                        known.clear()
                    known[key] = answers
            for found in answers:
                if found is None:
                    ways.append(None)
                    continue
                audit, fates, inserted, at = [], [], 0, 0
                for e in found[1]:
                    if e == "I":
                        inserted += 1
                        audit.append("I")
                        continue
                    fates.append(-1 if e == "D" else 2 * inserted + (e == "R"))
                    audit.append(e + "D" * (copies[at] - 1))
                    at, inserted = at + 1, inserted if e == "D" else 0
                ways.append({"cost": found[0], "exit": found[2], "audit": "".join(audit), "fates": fates})
            role = [c & 3 for c in codes]
            wrong = sum(copies) - len(role) + sum(p not in LEGAL for p in zip(role, role[1:], strict=False))
            out.append((ways, 2 * (sum(copies) - len(role)), wrong, role[0], role[-1]))
        way = pa.struct([("cost", pa.int64()), ("exit", pa.int32()), ("audit", pa.string()), ("fates", pa.list_(pa.int32()))])
        kinds = [pa.list_(way), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
        columns = [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns], names=["id", "part", "ways", "extra", "wrong", "first", "last"])


def _legal(a: Column, b: Column) -> Column:
    """Do roles of class a and b fit together?"""
    return (4 * a + b).isin([4 * x + y for x, y in sorted(LEGAL)])


def _rest_costs(pieces: DataFrame) -> DataFrame:
    """(cut_conv, cut_part, ends, leads) of the pieces of conversations that ranges cut: the costs of what follows."""
    cut = pieces.where("through is not null").groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "through")), asc=False).alias("p")).where(F.size("p") > 1)
    start = F.struct(F.array(*(F.lit(x).cast("long") for x in ENDS)).alias("v"), F.array().cast("array<struct<part:int,ends:array<bigint>>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        before = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda q: F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda r: F.get(x["through"], 4 * q + r) + F.get(acc["v"], r))))
        return F.struct(before.alias("v"), F.concat(acc["out"], F.array(F.struct(x["part"].alias("part"), acc["v"].alias("ends")))).alias("out"))

    rest = cut.select("conv", F.aggregate("p", start, step)["out"].alias("out"))
    return rest.select("conv", F.explode("out").alias("o"), F.element_at("out", -1)["part"].alias("head")).select(
        F.col("conv").alias("cut_conv"), F.col("o.part").alias("cut_part"), "o.ends", (F.col("o.part") == F.col("head")).alias("leads")
    )


def plan_repairs(rows: DataFrame, parts: int) -> DataFrame:
    """rows (conv struct<id>, turn, role, digest, code, copies), unique but for copies, to (conv, cost, audit, fates, tail, illegal).

    fates: for each row, in order (see _solve); tail: turns inserted at the end; illegal: neighbouring
    rows whose roles don't fit together.
    """
    order = ["conv", "turn", "role", "digest"]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("conv.id", F.spark_partition_id().alias("part"), "code", "copies")
    kind = dealt.schema["id"].dataType.simpleString()
    pieces = dealt.mapInArrow(_pieces, f"id {kind}, part int, codes binary, copies array<long>, through array<long>")
    pieces = pieces.select(F.struct("id").alias("conv"), "part", "codes", "copies", "through").checkpoint()
    ends = F.coalesce("ends", F.array(*(F.lit(x).cast("long") for x in ENDS))).alias("ends")
    asked = pieces.join(_rest_costs(pieces), (F.col("conv") == F.col("cut_conv")) & (F.col("part") == F.col("cut_part")), "left")
    solved = asked.select("conv.id", "part", "codes", "copies", ends, F.coalesce("leads", F.lit(True)).alias("leads")).mapInArrow(
        _solve, f"id {kind}, part int, ways array<{WAY}>, extra long, wrong long, first int, last int"
    )
    whole = solved.groupBy(F.struct("id").alias("conv")).agg(F.sort_array(F.collect_list(F.struct("part", "ways", "extra", "wrong", "first", "last"))).alias("p"))  # a piece a range at most
    start = F.struct(F.lit(0).alias("state"), F.lit(-1).alias("last"), F.lit(0).cast("long").alias("extra"), F.lit(0).cast("long").alias("wrong"), F.array().cast("array<string>").alias("audit"), F.array().cast("array<array<int>>").alias("fates"))

    def step(acc: Column, x: Column) -> Column:
        way = F.get(x["ways"], acc["state"])
        border = F.when((acc["last"] >= 0) & ~_legal(acc["last"], x["first"]), 1).otherwise(0)
        return F.struct(
            way["exit"].alias("state"), x["last"].alias("last"), (acc["extra"] + x["extra"]).alias("extra"), (acc["wrong"] + x["wrong"] + border).alias("wrong"),
            F.concat(acc["audit"], F.array(way["audit"])).alias("audit"), F.concat(acc["fates"], F.array(way["fates"])).alias("fates"),
        )

    a = F.aggregate("p", start, step)
    out = whole.select("conv", F.get(F.get("p", 0)["ways"], 0)["cost"].alias("cost"), a.alias("a"))
    tail = F.get(F.array(*(F.lit(x // INSERT) for x in ENDS)), F.col("a.state"))
    return out.select(
        "conv", (F.col("cost") + F.col("a.extra")).alias("cost"), F.concat(F.array_join("a.audit", ""), F.repeat(F.lit("I"), tail)).alias("audit"),
        F.flatten("a.fates").alias("fates"), tail.alias("tail"), F.col("a.wrong").alias("illegal"),
    )


def repair_conversations(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies_col: str | None = None, parts: int | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired) of each conversation.

    Rows stand in order of turn, nulls first; rows of one turn by role, then by a digest of the text.
    copies_col: how often a row stands there, 0 for a row that only names its conversation; without it,
    once. A null role or text is one space; a null id is a conversation of its own. A row's first fault
    counts: blank, duplicate (role and text were there before), truncated (ends without . ! or ?).
    gaps: turns missing between the first and last, without nulls. A conversation without rows has
    zeros and empty strings. Repeated rows are counted before they move, and ranges deal a long
    conversation out to many tasks; only its result, the audit and the repaired text, is one value.
    Texts of the same bytes by SHA-256 are one. Other columns are not read.
    """
    spark = turns.sparkSession
    use_checkpoints(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    copies = F.coalesce(F.col(copies_col), F.lit(0)).cast("long") if copies_col else F.lit(1).cast("long")
    own = turns.select(F.struct(F.col(conv_col).alias("id")).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"), copies.alias("copies"))
    own = own.withColumn("digest", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))

    shown = F.rtrim("text", F.lit(SPACES))
    flags = own.select("conv", "turn", "role", "digest", "copies", shown.alias("shown")).select(
        "conv", "turn", "role", "digest", "copies", (F.col("shown") == "").alias("blank"), (~F.substring("shown", -1, 1).isin(".", "!", "?")).alias("open")
    )
    rows = flags.groupBy("conv", "turn", "role", "digest", "blank", "open").agg(F.sum("copies").alias("copies")).checkpoint()
    live = rows.where("copies > 0")
    again = live.groupBy("conv", "role", "digest").agg(F.min(F.struct(F.col("turn").isNotNull().alias("has"), "turn")).alias("earliest"), F.count("*").alias("places")).where("places > 1")
    again = again.select(F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "earliest")
    met = live.join(again, (F.col("conv") == F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d")), "left")
    is_first = F.coalesce(F.col("turn").eqNullSafe(F.col("earliest.turn")), F.lit(True)) | F.col("earliest").isNull()
    initial = F.substring("role", 1, 1)
    role_class = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    marked = met.select("conv", "turn", "role", "digest", "copies", "blank", "open", is_first.alias("is_first"), role_class.alias("class"))
    stays = ~F.col("blank") & F.col("is_first")
    code = F.col("class") + F.when(stays, 0).otherwise(FORCED) + F.when(stays & F.col("open"), UNFINISHED).otherwise(0)

    zero = F.lit(0).cast("long")
    extent = rows.groupBy("conv").agg(
        F.max(F.when(F.col("copies") > 0, F.col("turn"))).alias("high"), F.min(F.when(F.col("copies") > 0, F.col("turn"))).alias("low"), F.count_distinct(F.when(F.col("copies") > 0, F.col("turn"))).alias("turns")
    )
    faults = marked.groupBy("conv").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(zero)).alias("blank"),
        F.sum(F.when(~F.col("blank"), F.col("copies") - F.col("is_first").cast("long")).otherwise(zero)).alias("duplicate"),
        F.sum((stays & F.col("open")).cast("long")).alias("truncated"),
    )
    plan = plan_repairs(marked.select("conv", "turn", "role", "digest", code.alias("code"), "copies"), parts)
    texts = own.where("copies > 0").groupBy("conv").agg(F.sort_array(F.collect_set(F.struct("turn", "role", "digest", "text"))).alias("rows"))

    def same(other: str) -> Column:
        return F.col("extent.conv") == F.col(f"{other}.conv")  # structs, whose null ids are equal

    joined = extent.alias("extent").join(faults.alias("faults"), same("faults"), "left").join(plan.alias("plan"), same("plan"), "left").join(texts.alias("texts"), same("texts"), "left")
    entry = lambda role, text: F.struct(role.cast("string").alias("role"), text.alias("text"))
    added = entry(F.lit(None), F.lit(""))
    stay = F.zip_with(
        F.col("rows"), F.col("fates"),
        lambda r, f: F.when(f < 0, F.array().cast("array<struct<role:string,text:string>>")).otherwise(
            F.concat(F.array_repeat(added, F.shiftright(f, 1)), F.array(entry(F.when(f % 2 == 0, r["role"]), r["text"])))
        ),
    )
    turns_out = F.concat(F.flatten(stay), F.array_repeat(added, F.col("tail")))
    odd = F.size("out") % 2
    lines = F.transform("out", lambda x, j: F.concat(F.coalesce(x["role"], F.when((j - odd) % 2 == 0, "user").otherwise("assistant")), F.lit(":"), x["text"]))
    out = joined.select("extent.conv", "high", "low", "turns", "blank", "duplicate", "truncated", "illegal", "cost", "audit", turns_out.alias("out"))
    number = lambda c: F.coalesce(F.col(c), zero).alias(c)
    return out.select(
        F.col("conv.id").alias("conv_id"), F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), zero).cast("long").alias("gaps"), *map(number, ("blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce(F.array_join(lines, "\n"), F.lit("")).alias("repaired"),
    )


def with_damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): for test data, rows damaged by a checksum of `conv_id:turn`.

    By the CRC-32 mod 20: 0 drops the row (copies 0), 1 empties its text, 2 removes its . ! and ?,
    3 doubles it (copies 2), 4 makes it the user's. Null values count as one space.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    rows = turns.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
    )
