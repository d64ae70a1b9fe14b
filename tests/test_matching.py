"""J1 (LIFO fold) against a direct transcription of the greedy rule; C5 coverage."""
import datetime as dt
import random

from faultline.operators import events as ev


def brute(fails, alerts, h):
    alerts = sorted(alerts)
    used, tp, fn = set(), 0, 0
    for f in sorted(fails):
        cand = None
        for i in range(len(alerts) - 1, -1, -1):
            if i in used:
                continue
            if f - h <= alerts[i] < f:
                cand = i
                break
        if cand is None:
            fn += 1
        else:
            tp += 1
            used.add(cand)
    return tp, fn, len(alerts) - len(used)


def test_match_vs_brute_force(spark):
    rnd = random.Random(7)
    base = dt.date(2024, 1, 1)
    readings, alerts, expect = [], [], {}
    for d in range(300):
        dev = f"D{d}"
        days = sorted(rnd.sample(range(40), rnd.randint(1, 25)))
        fails = [x for x in days if rnd.random() < 0.2]
        al = [x for x in range(40) if rnd.random() < 0.15]
        for x in days:
            readings.append((dev, base + dt.timedelta(days=x), int(x in fails)))
        for x in al:
            alerts.append((dev, base + dt.timedelta(days=x), 1))
        if fails:
            expect[dev] = brute(fails, al, 5)
    r = spark.createDataFrame(readings, "device string, date date, failure int")
    a = spark.createDataFrame(alerts, "device string, date date, pred int")
    got = {row["device"]: (row["tp_events"], row["fn_events"], row["fp_alerts"])
           for row in ev.match_alerts_failures(r, a, 5).collect()}
    assert got == expect


def test_healthy_devices_ignored_and_same_day_alert(spark):
    base = dt.date(2024, 1, 10)
    r = spark.createDataFrame([("A", base, 1), ("B", base, 0)], "device string, date date, failure int")
    a = spark.createDataFrame([("A", base, 1), ("A", base - dt.timedelta(days=3), 1), ("B", base, 1)],
                              "device string, date date, pred int")
    got = {x["device"]: tuple(x[1:]) for x in ev.match_alerts_failures(r, a, 3).collect()}
    assert got == {"A": (1, 0, 1)}  # same-day alert cannot cover; B (no failure) ignored
    cov = ev.covered_failures(r, a, 3).count()
    assert cov == 1
