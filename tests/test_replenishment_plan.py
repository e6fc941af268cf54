"""The replenishment plan against loops over items and months."""

import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from quarrymill.operators import adjustments, plan, replenish
from quarrymill.operators.forecast import seasonal_forecast

END, H = "2026-09-01", 4


def month(i: int) -> date:
    return date(2024 + i // 12, i % 12 + 1, 1)


@pytest.fixture(scope="module")
def inputs(spark):
    rng = random.Random(12)
    rows = []
    for key in range(1, 13):
        first = {9: 27, 10: 31, 11: 24}.get(key, 0)
        for i in range(first, 33):  # 2024-01 .. 2026-09
            sold = 0.0 if key == 12 else float(rng.randint(20, 90))
            stock = None if key in (4, 10) and i > 27 else float(rng.randint(0, 120))
            got = float(rng.choice([0, 0, 150, 40])) if key != 7 else 0.0
            rows.append((key, month(i), sold, stock, got, float(rng.randint(0, 60))))
    months = spark.createDataFrame(rows, "key long, month date, sales double, stock double, received double, open_po double")
    weekly = [(k, 1, date(2026, 10, d), 30.0 + k, 40.0 + k, 55.0 + k) for k in (1, 2, 4, 9, 10, 77) for d in (3, 10, 17, 24, 31)]
    weekly += [(k, 1, date(2026, 11, d), 20.0 + k, 33.0 + k, 41.0 + k) for k in (1, 9) for d in (7, 14, 21, 28)]
    return months, spark.createDataFrame(weekly, "key long, version int, week_end date, mean double, p80 double, p90 double")


LINES = [
    ("UK", "1", "", "demand_multiplier", "1.5", "", ""), ("uk", "1", "2026-11-01", "demand_multiplier", "0.8", "promo ends", ""), ("", "2", "2026-10-15", "demand_override", "1,200", "", ""),
    ("", "2", "2026-10-01", "demand_override", "300", "later line", ""), ("", "3", "2026-12-01", "pinned_order", "250", "container 2", ""), ("", "3", "2026-12-01", "pinned_order", "50", "", ""),
    ("", "5", "", "stock_override", "500", "", ""), ("", "5", "", "open_po_override", "0", "", ""), ("", "6", "", "cover_override", "3", "", ""), ("", "6", "", "lot_override", "900", "", ""),
    ("", "7", "2026-11-01", "discontinue", "", "", ""), ("", "8", "", "delay_orders", "1", "", "2026-12-31"), ("", "8", "", "stock_override", "0", "", ""), ("", "8", "", "open_po_override", "0", "", ""), ("", "4", "", "delay_orders", "2", "", ""), ("", "4", "2026-12-01", "discontinue", "", "", ""),
    ("DE", "9", "", "demand_multiplier", "9", "other market", ""), ("", "9", "", "demand_multiplier", "9", "over", "2026-09-30"), ("", "10", "2026-10-01", "pinned_order", "20", "", ""), ("", "1", "2030-01-01", "demand_override", "7", "outside", ""),
]


def entered(spark, lines):
    schema = ", ".join(f"{c} string" for c in adjustments.FIELDS) + ", line int"
    rows = [(m, a, mo, t, v, n, u, i + 2) for i, (m, a, mo, t, v, n, u) in enumerate(lines)]
    return adjustments.read_adjustments(spark.createDataFrame(rows, schema))


def brute(spark, months, weekly, lines, weight=0.5):
    """{(key, step): (units, p80, p90, reason, detail codes)} by loops; habits and own demand from the operators."""
    known = {}
    for r in months.orderBy("month").collect():
        known.setdefault(r.key, []).append(r)
    own = {}
    sales = months.select("key", "month", F.col("sales").alias("units"))
    for r in seasonal_forecast(sales, END, H, 12, 0.5).collect():
        own[r.key, r.step - 1] = r.predicted
    habits = {r.key: r for r in replenish.learn_habits(months.drop("open_po")).collect()}
    share = replenish.po_share(months).first()[0]
    market = {}
    for r in replenish.weekly_to_monthly(weekly).collect():
        market[r.key, (r.month.year - 2026) * 12 + r.month.month - 10] = (r["mean"], r.p80, r.p90)
    r80, r90 = replenish.uplift_ratios(replenish.weekly_to_monthly(weekly)).first()
    out = {}
    for key, rows in known.items():
        young = (key, 0) not in own
        if young and (sum(r.sales for r in rows) == 0 or len(rows) < 3):
            continue
        base = [own[key, h] for h in range(H)] if not young else [sum(r.sales for r in rows[-3:]) / len(rows[-3:])] * H
        stock = next((r.stock for r in rows[:-4:-1] if r.stock is not None), None)
        po, cover, lot, stop, delay, notes = rows[-1].open_po, habits[key].cover, habits[key].lot, None, 0, []
        mult, fixed, pinned, codes = [1.0] * H, [None] * H, [0.0] * H, set()
        for m, a, mo, t, v, note, until in lines:
            if a != str(key) or m.upper() not in ("", "UK") or (until and until < "2026-10-01"):
                continue
            v = float(v.replace(",", "")) if v else None
            steps = [h for h in range(H) if not mo or mo[:7] == month(33 + h).strftime("%Y-%m")]
            if t in adjustments.BY_MONTH and not steps:
                continue
            if t == "demand_multiplier":
                for h in steps:
                    mult[h] *= v
            elif t == "demand_override":
                for h in steps:
                    fixed[h] = v
            elif t == "pinned_order":
                pinned[steps[0]] += v
            elif t == "stock_override":
                stock = v
                codes.add("STOCK_OVERRIDE")
            elif t == "open_po_override":
                po = v
                codes.add("OPEN_PO_OVERRIDE")
            elif t == "cover_override":
                cover = v
            elif t == "lot_override":
                lot = v
            elif t == "discontinue":
                stop = min([*steps, stop if stop is not None else H])
            else:
                delay = round(v)
            notes.append(t + (f" {mo[:7]}" if mo else "") + (f" {v:g}" if v is not None else "") + (f" ({note})" if note else ""))
            if t in ("cover_override", "lot_override"):
                codes.add("HABIT_OVERRIDE")
        blind = stock is None
        w = weight if not young else (1.0 if not blind else 0.0)
        dem, use = [[], [], []], []
        for h in range(H):
            m = market.get((key, h)) if w > 0 else None
            use.append(m is not None)
            x = w * m[0] + (1 - w) * base[h] if m else base[h]
            y = max(x + w * (m[1] - m[0]) if m else base[h] * r80, x)
            z = max(x + w * (m[2] - m[0]) if m else base[h] * r90, y)
            for k, (value, r) in enumerate(((x, 1), (y, r80), (z, r90))):
                dem[k].append((fixed[h] * r if fixed[h] is not None else value) * mult[h])
        totals, first = [], None
        for k in range(3):
            s, records = stock or 0.0, []
            for h in range(H):
                arriving = po * share if h == 0 else po * (1 - share) if h == 1 else 0.0
                s = max(s - dem[k][h] + arriving + pinned[h], 0.0)
                gap = cover * (dem[k][h + 1] if h + 1 < H else dem[k][h]) - s
                want, off = gap > 1e-9, stop is not None and h >= stop
                new = max(gap, 0.25 * lot) if want and not off else 0.0
                records.append((arriving + pinned[h], new, arriving, want and not off, want and not off and 0.25 * lot > gap, want and off))
                s += new
            first = first or records
            totals.append([max(dem[k][h], 0) * (stop is None or h < stop) + pinned[h] if blind else records[h][0] + (records[h - delay][1] if h >= delay else 0.0) for h in range(H)])
        if notes:
            codes.add("CLIENT_ADJUSTED")
        if not blind:
            codes.add("HABIT_" + habits[key].source.upper())
            codes |= {"ORDERS_DELAYED"} if delay else set()
        else:
            codes = {c for c in codes if c != "HABIT_OVERRIDE"} | ({"DELAY_NOT_APPLIED_NO_STOCK"} if delay else set())
        for h in range(H):
            units, p80, p90 = (round(max(t[h], 0.0), 2) for t in totals)
            now, src = first[h], first[h - delay] if h >= delay else (0, 0, 0, False, False, False)
            extra = set(codes)
            if pinned[h] > 1e-9:
                extra.add("PINNED_ORDER")
            if units <= 0 and max(p80, p90) > 0:
                extra.add("HIGH_CASE_ORDER_ONLY")
            stopped = stop is not None and h >= stop
            if blind:
                primary = "NO_ORDER_DISCONTINUED" if stopped and units <= 0 else "SALES_ONLY_NO_STOCK"
                extra.add("SALES_ONLY_NO_STOCK")
            else:
                if now[2] > 1e-9:
                    extra.add("OPEN_PO_DELIVERY")
                if units <= 0:
                    primary = "NO_ORDER_DELAYED" if delay and now[3] else "NO_ORDER_DISCONTINUED" if src[5] else "NO_ORDER_STOCK_COVERS"
                elif src[3]:
                    primary = "REORDER_MIN_ORDER_SIZE" if src[4] else "REORDER_TRIGGERED"
                else:
                    primary = "PINNED_ORDER" if pinned[h] > 1e-9 else "OPEN_PO_DELIVERY"
            extra |= {"DISCONTINUED"} if stopped else set()
            if young:
                extra |= {"DEMAND_AMAZON_FORECAST"} if use[h] else {"DEMAND_RECENT_AVERAGE"}
                extra.add(primary)
                primary = "YOUNG_PRODUCT_BACKUP"
            else:
                extra.add("DEMAND_AMAZON_BLEND" if use[h] else "DEMAND_OWN_NO_AMAZON")
            extra |= {"DEMAND_OVERRIDE"} if fixed[h] is not None else set()
            extra |= {"DEMAND_MULTIPLIER"} if mult[h] != 1 else set()
            rest = sorted(extra - {primary}, key=replenish.REASONS.index)
            level = {primary, *rest}
            label = "LOW" if level & set(replenish.LOW) else "MEDIUM" if level & set(replenish.MEDIUM) else "HIGH"
            out[key, h] = (units, p80, p90, "sales_only" if blind else "replay", "; ".join(notes), primary, "|".join([primary, *rest]), label)
    return out


@pytest.mark.parametrize("lines", [[], LINES])
def test_plan_against_loops(spark, inputs, lines):
    months, weekly = inputs
    given = adjustments.usable_adjustments(entered(spark, lines), "UK", "2026-10-01") if lines else None
    made = plan.plan(months, weekly, END, H, 0.5, adjustments=given).collect()
    want = brute(spark, months, weekly, lines)
    got = {(r.key, (r.month.year - 2026) * 12 + r.month.month - 10): r for r in made}
    assert got.keys() == want.keys()
    for k, (units, p80, p90, *rest) in want.items():
        r = got[k]
        assert (r.basis, r.adjustments, r.reason, r.detail, r.confidence) == tuple(rest), (k, r, rest)
        assert all(abs(a - b) <= 0.011 for a, b in ((r.units, units), (r.p80, p80), (r.p90, p90))), (k, r, units, p80, p90)
        assert (r.order_chance is None) == (r.basis == "sales_only")
    if lines:
        seen = {c for r in made for c in r.detail.split("|")}
        assert {"NO_ORDER_DELAYED", "ORDERS_DELAYED", "STOCK_OVERRIDE", "OPEN_PO_OVERRIDE", "HABIT_OVERRIDE", "DEMAND_OVERRIDE", "DEMAND_MULTIPLIER", "DISCONTINUED", "DELAY_NOT_APPLIED_NO_STOCK", "PINNED_ORDER"} <= seen


def test_decisions_and_summary(spark, inputs):
    months, weekly = inputs
    made = plan.plan(months, weekly, END, H)
    decided = {r.key: r for r in plan.decisions(made, months, weekly, END, H).collect()}
    assert {k: r.status for k, r in decided.items() if r.status != "FORECAST"} == {77: "AMAZON_FORECAST_ONLY", 10: "SHORT_HISTORY"}
    assert decided[77].reason_code == "AMAZON_FORECAST_ONLY" and decided[77].months_of_history == 0
    assert decided[9].reason_code == "YOUNG_PRODUCT_BACKUP" and decided[4].reason_code == "SALES_ONLY_NO_STOCK" and decided[1].amazon_months == 2
    assert decided[10].months_of_history == 2 and decided[12].status == "FORECAST"  # twelve months of zeros are a history
    doc = json.loads(plan.summary(made, plan.decisions(made, months, weekly, END, H)).first()[0])
    assert doc["asins_forecast"] == sum(r.status == "FORECAST" for r in decided.values()) and doc["amazon_only_dropped"] == 1
    assert sum(doc["reason_rows"].values()) == made.count() and doc["units_forecast_total"] > 0


def test_bad_adjustments_stop_the_run(spark):
    bad = [("", "1", "", "nonsense", "1", "", ""), ("", "1", "", "stock_override", "many", "", ""), ("", "1", "", "pinned_order", "5", "", ""), ("", "1", "2026-13-01", "discontinue", "", "", ""), ("", "", "", "nonsense", "", "", "")]
    rows = entered(spark, bad)
    assert [r.problem is None for r in rows.orderBy("line").collect()] == [False] * 4
    with pytest.raises(ValueError, match="line 2: unknown type 'nonsense'; line 3: type stock_override needs a number"):
        adjustments.usable_adjustments(rows, "UK", "2026-10-01")


def test_short_numbers(spark):
    values = [0.0, 1.5, 20.0, 0.8, 1200.0, 123456.0, 1234567.0, 0.00012, 0.00001234, 3.14159265, 99999.94, -2.5, 1e-9]
    df = spark.createDataFrame([(v,) for v in values], "v double").select(adjustments.short_number(F.col("v")).alias("s"))
    assert [r.s for r in df.collect()] == [f"{v:g}" for v in values]


def test_backtest_is_the_replay_at_each_origin(spark, inputs):
    months, _ = inputs
    out = plan.backtest(months, ["2026-03-01", "2026-05-01"], 3).collect()
    assert {str(r.train_end) for r in out} == {"2026-03-01", "2026-05-01"} and {r.step for r in out} == {1, 2, 3} and all(r.predicted >= 0 for r in out)
    alone = plan.backtest(months.where("month <= '2026-05-01'"), ["2026-05-01"], 3).collect()
    pick = lambda rows: sorted((r.key, r.step, round(r.predicted, 6)) for r in rows if str(r.train_end) == "2026-05-01")
    assert pick(out) == pick(alone)  # nothing after an origin is read


def test_backtest_reads_the_months_once_whatever_the_origins(spark, inputs):
    months, _ = inputs
    nodes = lambda origins: [line.split("(")[0].strip(" :+-*") for line in plan.backtest(months, origins, 3)._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    few, many = nodes(["2026-03-01"]), nodes([f"{y}-{m:02d}-01" for y in (2025, 2026) for m in range(1, 13)])
    assert len(few) == len(many) and sum("Union" in x for x in many) == 0
