"""The ledger against a version that goes row by row through plain dictionaries."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kerbline.operators import ledger

BOX = (38.8, 39.4, -75.7, -75.3)
TEXTS = ["route", "severity", "ped", "bike", "motorcycle", *ledger.FLAGS, "collision", "weather", "light", "surface", "fc", "facility", "description", "system", "crash_date", "crash_time", "crash_year"]
NUMBERS = ["k_people", "a_people", "b_people", "c_people", "ped_killed", "ped_injured"]
SCHEMA = "id long, lat double, lon double, " + ", ".join(f"{c} string" for c in TEXTS) + ", " + ", ".join(f"{c} int" for c in NUMBERS)


def rows_of(n, seed=4):
    rng = random.Random(seed)
    pick = lambda *x: rng.choice(x)
    out = []
    for k in range(n):
        route = pick("", None, "I-95", "US 13", "SR 7", f"R{rng.randrange(12)}", f"R{rng.randrange(12)}", f"only{k}")
        fc = pick("", "unknown", None, "1-Interstate (A,1)", "5-Major Collector (I,4)", "7-Local (J,6)") if route not in ("I-95", "US 13") else pick("", None)
        r = {
            "id": k, "lat": pick(0.0, None, 41.0, 39.45, round(38.8 + rng.random() * 0.6, 4), round(38.8 + rng.random() * 0.6, 4), round(38.8 + rng.random() * 0.6, 4)), "lon": pick(round(-75.7 + rng.random() * 0.4, 4), round(-75.7 + rng.random() * 0.4, 4), 0.0) if rng.random() < 0.3 else round(-75.7 + rng.random() * 0.4, 4),
            "route": route, "severity": pick("K", "A", "B", "C", "O", "", None), "fc": fc, "facility": pick("", "N/A", "4-Two-Way Divided", "3-Two-Way Undivided"),
            "ped": pick("Yes", "No", "", None), "bike": pick("Yes", "No"), "motorcycle": pick("No", None), "collision": pick("Rear end", "BIKE x", "a bicycle", "Motorcycle", "", None),
            "weather": pick("Rain", "unknown"), "light": pick("Day", None), "surface": pick("Dry", " NA "), "description": pick("", None, "1. Two-Way, Not Divided", "Positive Median Barrier", "2. Divided", "One way", "x"), "system": pick("", None, "DOT Interstate", "Primary", "Non-DOT secondary", "Local", "non"),
            "crash_date": pick("1/2/2020", "13/2/2020", "1/40/2020", "a/b/c", "1/2", "", None, "7/8/1950"), "crash_time": pick("1230", "0", "2400", "1161", "-5", "noon", "", None), "crash_year": pick("2020", "2019", "", None),
            **{f: pick("Yes", "No", "", "y", "1", "TRUE", "maybe", None) for f in ledger.FLAGS}, **{c: pick(0, 0, 1, 2) for c in NUMBERS},
        }
        out.append(r)
    return out


def blank(v):
    return (v or "").strip().lower() in ledger.UNKNOWN


def majority(votes, least=2):
    best = max(votes.items(), key=lambda x: (x[1], x[0]), default=(None, 0))
    return best[0] if best[1] >= least else None


def brute(rows):
    missing = lambda r: not r["lat"] or not r["lon"]
    out_of = lambda r, m=0.0: r["lat"] < BOX[0] - m or r["lat"] > BOX[1] + m or r["lon"] < BOX[2] - m or r["lon"] > BOX[3] + m
    on, route_fc, route_ft, fc_ft = defaultdict(list), defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    cells = defaultdict(list)
    for r in rows:
        if r["route"] and not missing(r) and not out_of(r, 0.05):
            on[r["route"]].append((r["lon"], r["lat"], r["id"]))
        if not missing(r) and not out_of(r):
            cells[int(r["lat"] / 0.01), int(r["lon"] / 0.01)].append(r)
        if r["route"] and not blank(r["fc"]):
            route_fc[r["route"]][r["fc"]] += 1
        if r["route"] and not blank(r["facility"]):
            route_ft[r["route"]][r["facility"]] += 1
        if not blank(r["fc"]) and not blank(r["facility"]):
            fc_ft[r["fc"]][r["facility"]] += 1
    mid = lambda rs, c: (2 * sum(round(r[c] * 1e6) for r in rs) + len(rs)) / (2 * len(rs))
    cells = {k: (math.trunc(mid(rs, "lat")) / 1e6, math.trunc(mid(rs, "lon")) / 1e6) for k, rs in cells.items()}
    issues, fixed_rows = [], []
    for r in rows:
        r, mine = dict(r), []
        route = r["route"] or ""
        median = sorted(on[route])[len(on[route]) // 2] if route and on[route] else None

        def note(check, severity, field, old, new=None, way=None):
            mine.append((r["id"], check, severity, field, old, new, new is not None, way if new is not None else None))

        place = lambda a, b: f"{a:.6f}, {b:.6f}"
        number = lambda v: "empty" if v is None else f"{v:.4f}"
        to, way = (median[1], median[0]) if median else None, f"route median (n={len(on[route])})"
        if missing(r):
            note("missing_gps", "error", "position", f"lon={number(r['lon'])}, lat={number(r['lat'])}", to and place(*to), way)
            if to:
                r["lat"], r["lon"] = to
        elif out_of(r):
            if not to:
                near = min(((math.hypot(r["lat"] - y, r["lon"] - x), k, (y, x)) for k, (y, x) in cells.items()), default=None)
                to, way = (near[2], "nearest cell") if near and near[0] < 0.1 else (None, None)
            note("bounds", "error", "position", f"{r['lat']:.4f}, {r['lon']:.4f}", to and place(*to), way)
            if to:
                r["lat"], r["lon"] = to
        told = next((k for k in "KABC" if r[f"{k.lower()}_people"] > 0), "O")
        if (r["severity"] or "") and told != "O" and r["severity"] != told:
            note("severity", "warning", "severity", r["severity"], told, "people")
            r["severity"] = told
        words = (r["collision"] or "").lower()
        for field, when, why in (("ped", r["ped_killed"] + r["ped_injured"] > 0, "counts"), ("bike", "bike" in words or "bicycl" in words, "collision"), ("motorcycle", "motorcycle" in words, "collision")):
            if r[field] == "No" and when:
                note("cross_field", "warning", field, "No", "Yes", why)
                r[field] = "Yes"
        for f in ledger.FLAGS:
            if (r[f] or "") not in ("", "Yes", "No"):
                new = "Yes" if r[f].upper() in ("Y", "1", "TRUE") else "No"
                note("cross_field", "info", f, r[f], new, "standard word")
                r[f] = new
        parts = (r["crash_date"] or "").split("/")
        if len(parts) == 3:
            try:
                m, d, y = map(int, parts)
                if not (1 <= m <= 12 and 1 <= d <= 31 and 1990 <= y <= 2030):
                    note("date_time", "warning", "crash_date", r["crash_date"])
                if r["crash_year"] and r["crash_year"] != str(y):
                    note("date_time", "warning", "crash_year", r["crash_year"], str(y), "date")
                    r["crash_year"] = str(y)
            except ValueError:
                note("date_time", "error", "crash_date", r["crash_date"])
        try:
            t = int(r["crash_time"] or "x")
            if t < 0 or t > 2359 or t % 100 >= 60:
                note("date_time", "warning", "crash_time", r["crash_time"])
        except ValueError:
            pass
        for f in ("severity", "collision", "weather", "light", "surface"):
            if blank(r[f]):
                note("missing_field", "warning", f, r[f])
        prefix = lambda k: next((x[k] for x in ledger.PREFIXES if re.match(x[0], route.upper())), None)
        like = lambda text, table: next((v for w, v in table if w in (text or "").lower()), None)
        for f, chain in (
            ("fc", lambda: [("route_majority", majority(route_fc[route]) or (list(route_fc[route])[0] if sum(route_fc[route].values()) == 1 else None)), ("system", like(r["system"], ledger.SYSTEMS)), ("prefix", prefix(1))]),
            ("facility", lambda: [("route_majority", majority(route_ft[route])), ("class_majority", majority(fc_ft[r["fc"]])), ("description", like(r["description"], ledger.DESCRIPTIONS)), ("prefix", prefix(2))]),
        ):
            if blank(r[f]):
                name, value = next(((n, v) for n, v in chain() if v), (None, None))
                note("missing_field", "warning", f, r[f], value, name)
                r[f] = value or r[f]
        issues += mine
        fixed_rows.append(r)
    return issues, fixed_rows


@pytest.fixture(scope="module")
def case(spark):
    rows = rows_of(500)
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA)
    return rows, df


def test_ledger(spark, case):
    rows, df = case
    issues, fixed = brute(rows)
    checked = ledger.run_checks(df.selectExpr("*", "'x' AS n", "'x' AS check", "'x' AS target_id"), BOX)
    got = [tuple(r[c] for c in ("row_id", "check", "severity", "field", "old", "new", "fixed", "way")) for r in ledger.issue_table(checked).collect()]
    assert Counter(got) == Counter(issues)
    ways = {g[7] for g in got}
    assert {"nearest cell", "route_majority", "system", "prefix", "class_majority", "description", "people", "counts", "collision", "date", "standard word"} <= ways
    left = {r.id: r for r in ledger.corrected(checked).collect()}
    for r in fixed:
        assert all(left[r["id"]][c] == r[c] for c in [*TEXTS, *NUMBERS]) and left[r["id"]].check == "x"
        assert all((a is None and b is None) or abs(a - b) < 1e-9 for a, b in ((left[r["id"]][c], r[c]) for c in ("lat", "lon")))
    sums = Counter((i[1], i[2]) for i in issues)
    assert {(r.check, r.severity): r.n for r in ledger.report(checked).collect()} == dict(sums)
    # Mended rows have nothing left that could be mended.
    again = ledger.issue_table(ledger.run_checks(ledger.corrected(checked), BOX, ("severity", "cross_field", "datetime")))
    assert again.where("fixed").count() == 0


def test_one_group_alone_and_no_rows(spark, case):
    rows, df = case
    issues, _ = brute(rows)
    got = ledger.issue_table(ledger.run_checks(df, BOX, ("datetime",))).collect()
    assert len(got) == sum(i[1] == "date_time" for i in issues)
    assert ledger.issue_table(ledger.run_checks(df.limit(0), None)).count() == 0
    # Own bounds from the rows' middle; a far row is found by them, and of fewer than a hundred rows nothing is said.
    fine = df.where("lat BETWEEN 38.8 AND 39.4 AND lon < -1")
    far = fine.limit(1).withColumns({"id": F.lit(9999).cast("long"), "lat": F.lit(45.0)})
    out = lambda x: {r.row_id for r in ledger.issue_table(ledger.run_checks(x, None, ("gps",))).where(F.col("check") == "bounds").collect()}
    assert fine.count() > 150 and out(fine.unionByName(far)) == {9999} and out(fine.limit(50).unionByName(far)) == set()


def test_rows_are_derived_twice_and_notes_share_projections(spark, case, monkeypatch):
    """Once for what is learnt, as a narrow table, and once for the checks, whose notes don't stack a projection each."""
    _, df = case
    seen, kept = [], ledger.kept
    monkeypatch.setattr(ledger, "kept", lambda x: seen.append(x._jdf.queryExecution().optimizedPlan().toString()) or kept(x))
    plan = ledger.checks(df, BOX)._jdf.queryExecution()
    assert sum("LogicalRDD" in p for p in seen) == 1
    assert plan.optimizedPlan().toString().count("LogicalRDD") == 1 and plan.analyzed().toString().count("Project") < 40
