"""The ten figures, target series and reconciled forecasts against versions in plain Python."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kerbline.operators import outlook

W = {"K": 883, "A": 94, "B": 21, "C": 11, "O": 1}


def crashes_of(n, seed=3):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        scope = rng.choice("XXXXY")
        at = rng.randrange(30) if scope == "X" else rng.choice([2, 3, 5, 9])
        month = dt.date(2021 + at // 12, at % 12 + 1, 1)
        out.append((scope, month, rng.choice("KAABBCCOOOOO"), rng.choice(["", "R1", "R1", "R2", "R3", "R4", "R5"]), rng.choice(["rear", "side"] + ["angle"] * (at > 20)), rng.choice(["segment", "segment", "four_leg", "roundabout", "other"]), rng.random() < 0.3 + at / 100, rng.random() < 0.05))
    return out


@pytest.fixture(scope="module")
def case(spark):
    rows = crashes_of(2500)
    df = spark.createDataFrame(rows, "place string, month date, severity string, route string, kind string, location string, speed boolean, night boolean")
    history = outlook.monthly(df, "place", F.col("kind"), F.col("location"), {"speed": F.col("speed"), "night": F.col("night")}, n_routes=3).cache()
    forecasts = outlook.forecast_all(history).cache()
    return rows, history, forecasts


def series_of(rows):
    """(scope, target, key) -> values by month, zeros included."""
    counts, months = defaultdict(Counter), defaultdict(set)
    for scope, month, sev, route, kind, where, speed, night in rows:
        keys = [("total", "all"), ("severity", sev), ("type", kind), ("location", where)] + [("factor", k) for k, on in (("speed", speed), ("night", night)) if on] + ([("corridor", route)] if route else [])
        months[scope].add(month)
        for t, k in keys:
            counts[scope, t, k][month] += 1
    out = {}
    for (scope, t, k), c in counts.items():
        if t == "corridor":
            order = sorted((-sum(x.values()), key) for (s, u, key), x in counts.items() if s == scope and u == t)
            if k not in [key for _, key in order[:3]]:
                continue
        a, b = min(months[scope]), max(months[scope])
        all_months = [dt.date(y, m, 1) for y in range(a.year, b.year + 1) for m in range(1, 13) if a <= dt.date(y, m, 1) <= b]
        out[scope, t, k] = [c[m] for m in all_months]
    return out


def figures(series, told):
    """told: (scope, target, key) -> rows of the next months in order."""
    out = {}
    change = lambda now, was: round((now - was) / max(was, 1) * 100, 1) if was else 0
    for scope in {s for s, _, _ in series}:
        put = lambda figure, key, label="", **m: out.update({(scope, figure, key, k): (v, label) for k, v in m.items()})
        total, all_told = series[scope, "total", "all"], told[scope, "total", "all"]
        sev = {k: series.get((scope, "severity", k), []) for k in W}
        ahead = {k: [r.p50 for r in told.get((scope, "severity", k), [])] for k in W}
        months = range(len(all_told))
        widths = [round(r.p90 - r.p10, 1) for r in all_told]
        mean = sum(r.p50 for r in all_told) / len(all_told)
        width = round(sum(widths) / len(widths), 1)
        cv = round(width / max(mean, 1) * 100, 1)
        put("confidence_width", "", "low" if cv < 30 else "moderate" if cv < 60 else "high", avg_width=width, variation=cv)
        at = lambda k, i: ahead[k][i] if ahead[k] else 0
        epdo = [round(sum(at(k, i) * w for k, w in W.items())) for i in months]
        ka = [at("K", i) + at("A", i) for i in months]
        last = {k: sum(v[-6:]) for k, v in sev.items()}
        was, will = sum(last[k] * w for k, w in W.items()), sum(epdo[:6])
        put("epdo_forecast", "", predicted=will, historical=was, change_pct=change(will, was))
        ka_will, ka_was = sum(round(x, 1) for x in ka[:6]), last["K"] + last["A"]
        put("ka_forecast", "", "worsening" if ka_will > ka_was else "improving", predicted=round(ka_will, 1), historical=ka_was)
        sums, nxt = {k: sum(v) for k, v in sev.items()}, {k: round(sum(v[:6])) for k, v in ahead.items()}
        h, p = (round((x["K"] + x["A"]) / max(sum(x.values()), 1) * 100, 2) for x in (sums, nxt))
        shift = round(p - h, 2)
        put("severity_shift", "", "worsening" if shift > 0.5 else "stable" if shift > -0.5 else "improving", historical=h, predicted=p, shift=shift)
        trend = (sum(total[-6:]) - sum(total[-12:-6])) / max(sum(total[-12:-6]), 1) * 100 if len(total) >= 12 else 0
        score = round(change(will, was) * 0.5 + trend * 0.3 + shift * 2, 1)
        put("composite_risk", "", "critical" if score > 10 else "elevated" if score > 5 else "moderate" if score > -5 else "low", score=score, total_trend=round(trend, 1), severity_shift=shift, epdo_change=change(will, was))
        soon = lambda t, k: sum(r.p50 for r in told[scope, t, k][:6])
        mine = lambda t: [k for s, u, k in series if (s, u) == (scope, t)]
        cross = sum(soon("location", k) for k in mine("location") if k in ("four_leg", "three_leg", "roundabout"))
        other = sum(soon("location", k) for k in mine("location")) - cross
        put("location_split", "", intersection=round(cross), segment=round(other), intersection_pct=round(cross / max(cross + other, 1) * 100, 1), segment_pct=round(other / max(cross + other, 1) * 100, 1))
        past = lambda t, k: sum(series[scope, t, k][-6:]) if len(total) >= 6 else 0
        routes = {k: (past("corridor", k) / 6, soon("corridor", k) / 6) for k in mine("corridor")}
        place = lambda j: {k: n for n, k in enumerate(sorted(routes, key=lambda k: (-round(routes[k][j], 1), k)), 1)}
        for k, (a, b) in routes.items():
            pct = round((b - a) / max(a, 1) * 100, 1)
            spread = round(sum(r.p90 - r.p10 for r in told[scope, "corridor", k][:6]) / 6, 1)
            put("corridor_movement", k, "rising" if pct > 5 else "falling" if pct < -5 else "stable", historical=round(a, 1), predicted=round(b, 1), change_pct=pct, width=spread, historical_rank=place(0)[k], predicted_rank=place(1)[k], moved=place(0)[k] - place(1)[k])
        for k in mine("type"):
            y = [r.p50 for r in told[scope, "type", k]]
            x = (len(y) - 1) / 2
            slope = sum((i - x) * (v - sum(y) / len(y)) for i, v in enumerate(y)) / sum((i - x) ** 2 for i in range(len(y)))
            pct = change(soon("type", k), past("type", k))
            put("type_momentum", k, "accelerating" if pct > 10 else "decelerating" if pct < -10 else "steady", historical=past("type", k), predicted=round(soon("type", k)), change_pct=pct, slope=round(slope, 2), total=sum(series[scope, "type", k]))
        for k in mine("factor"):
            put("factor_trend", k, historical=past("factor", k), predicted=round(soon("factor", k)), change_pct=change(soon("factor", k), past("factor", k)), involvement_pct=round(soon("factor", k) / max(soon("total", "all"), 1) * 100, 1), total=sum(series[scope, "factor", k]))
        order = sorted(months, key=lambda i: (-epdo[i], i))
        for i in months:
            rank = order.index(i) + 1
            put("risk_calendar", str(all_told[i].month), "highest" if rank == 1 else "lowest" if rank == len(order) else "", total=round(all_told[i].p50, 1), ka=round(ka[i], 1), epdo=epdo[i], risk_rank=rank)
    return out


def test_targets(case):
    rows, history, _ = case
    got = defaultdict(list)
    for r in history.orderBy("month").collect():
        got[r.scope, r.target, r.key].append(r.value)
    assert dict(got) == series_of(rows) and len({k for s, t, k in got if t == "corridor" and s == "X"}) == 3


def test_figures(case):
    rows, history, forecasts = case
    told = defaultdict(list)
    for r in forecasts.orderBy("month").collect():
        told[r.scope, r.target, r.key].append(r)
    want = figures(series_of(rows), told)
    got = {(r.scope, r.figure, r.key, r.measure): (r.value, r.label) for r in outlook.figures(history, forecasts).collect()}
    assert got.keys() == want.keys() and len({k[1] for k in got}) == 10
    for k, (value, label) in want.items():
        # Halves are rounded up here and to even there, and sums of floats differ in their last places.
        step = 1.01 if k[1:] and k[3] in ("predicted", "intersection", "segment", "epdo") else 0.111
        assert abs(got[k][0] - value) <= step and got[k][1] == label, (k, got[k], value, label)
    assert sum(abs(got[k][0] - v) < 1e-6 for k, (v, _) in want.items()) > 0.9 * len(want)


def test_reconciled(case):
    _, _, forecasts = case
    plain = {(r.scope, r.target, r.key, r.month): r for r in forecasts.collect()}
    got = outlook.reconciled(forecasts).collect()
    assert len(got) == len(plain)
    sums = defaultdict(float)
    for r in got:
        p = plain[r.scope, r.target, r.key, r.month]
        if r.target in outlook.PARTS:
            for q in ("p10", "p50", "p90"):
                sums[r.scope, r.target, r.month, q] += r[q]
        else:
            assert all(r[q] == p[q] for q in ("p10", "p25", "p50", "p75", "p90"))
    for (scope, _, month, q), v in sums.items():
        assert v == pytest.approx(plain[scope, "total", "all", month][q], abs=1e-6)
    # Keys keep their proportions.
    one = {r.key: r.p50 for r in got if (r.scope, r.target) == ("X", "severity") and r.month == min(x.month for x in got if x.scope == "X")}
    raw = {k: plain["X", "severity", k, min(x.month for x in got if x.scope == "X")].p50 for k in one}
    assert all(one[k] * raw["O"] == pytest.approx(raw[k] * one["O"], rel=1e-9) for k in one)


def test_overall_grades(case):
    """From the grades of the single series, by hand."""
    from kerbline.operators.forecast import backtest

    _, history, _ = case
    series = history.where("target IN ('total', 'severity', 'corridor')").selectExpr("concat(scope, '|', target, '|', key) AS series", "month", "value")
    grades = defaultdict(lambda: defaultdict(list))
    for r in backtest(series).collect():
        scope, target, _ = r.series.split("|")
        grades[scope][target].append(r.grade)
    worth = {"A": 1, "B": 2, "C": 3, "D": 4}
    want = {}
    for scope, g in grades.items():
        one = lambda t: [worth.get(x, 3) for x in g[t] if x != "N/A"]
        mean = lambda t: sum(one(t)) / len(one(t)) if one(t) else 3
        score = 0.5 * worth.get(g["total"][0] if g["total"] else "", 3) + 0.3 * mean("severity") + 0.2 * mean("corridor")
        want[scope] = ("A" if score < 1.5 else "B" if score < 2.5 else "C" if score < 3.5 else "D", round(score, 4))
    got = {r.scope: (r.grade, r.score) for r in outlook.overall_grades(history).collect()}
    assert got.keys() == want.keys() and all(got[k][0] == v[0] and abs(got[k][1] - v[1]) < 1e-3 for k, v in want.items()) and "X" in got
