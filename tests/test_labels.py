"""Sliding windows and labels against a direct loop over each series."""

import random
from datetime import datetime, timedelta

import pytest

from eventloom.operators import labels as L

T0 = datetime(2020, 1, 1)
LABELS = ["BFLARE_LABEL", "CFLARE_LABEL", "MFLARE_LABEL", "XFLARE_LABEL"]
SCHEMA = "k long, ts timestamp_ntz, IS_TMFI boolean, XR_QUAL long, MFLARE long, XFLARE long, " + ", ".join(f"{c} string" for c in LABELS)


def make(rnd, k, n, quiet=0.97):
    rows = []
    for i in range(n):
        labels, counts = [], []
        for c in "BCMX":
            hit = rnd.random() > quiet
            tag = rnd.choice(["Primary", "Secondary", "Non-verified"])
            labels.append(f"{c}{rnd.randrange(1, 10)}.0@{rnd.randrange(100)}:{tag}" if hit else "None")
            counts.append(int(hit))
        rows.append((k, T0 + timedelta(minutes=12 * i), rnd.random() < 0.96, 0 if rnd.random() < 0.06 else 12, counts[2], counts[3], *labels))
    return rows


def loop(series, unmatched, cfg):
    out = {}
    n = len(series)
    for i in range(0, n - (cfg.obs + cfg.lat), cfg.step):
        obs = series[i:i + cfg.obs]
        lo, hi = i + cfg.obs + cfg.lat, min(i + cfg.obs + cfg.lat + cfg.pred, n)
        pred = series[lo:hi]

        def verified(cols):
            found = [r[c] for r in pred for c in cols if r[c] != "None"]
            return found, [f for f in found if f.endswith(("Primary", "Secondary"))]

        label, reason, outcome = None, None, None
        if sum(r[2] for r in obs) < len(obs) * cfg.min_trusted:
            reason = "TMFI_Filtered"
        elif sum(r[4] + r[5] for r in pred) == 0:
            inside = sorted(u for u in unmatched if pred[0][1] < u[0] < pred[-1][1])
            wide = series[max(lo - cfg.clear, 0):min(hi + cfg.clear if hi < n else n, n)]
            if inside:
                reason, label = "NONMATCHED_FL_Filter", f"{inside[0][1]}@{inside[0][0]:%Y-%m-%d %H:%M:%S}"
            elif sum(r[3] == 0 for r in pred) > cfg.max_low_quality * len(pred):
                reason = "XRAY_QUAL_Filter"
            elif cfg.use_clear and sum(r[4] + r[5] for r in wide):
                reason = "CLEAR_WINDOW_Filter"
            else:
                label = max(verified([6, 7])[1], default="FQ")
                outcome = "NF" if cfg.classes == "FLNF" else {"F": "Q"}.get(label[0], label[0])
        else:
            found, good = verified([8, 9])
            if good:
                label = max(good)
                outcome = "FL" if cfg.classes == "FLNF" else label[0]
            else:
                reason, label = "NON_VERIFIED_Filter", max(found)
        out[i] = (obs[0][1], obs[-1][1], reason or outcome, label, reason)
    return out


@pytest.mark.parametrize("cfg", [
    L.WindowConfig(), L.WindowConfig(obs=10, lat=3, pred=7, step=2), L.WindowConfig(obs=10, lat=5, pred=20, step=5, clear=10, use_clear=True),
    L.WindowConfig(obs=6, lat=0, pred=12, step=3, clear=15, use_clear=True, classes="XMCBQ"), L.WindowConfig(obs=8, lat=0, pred=16, step=8),
], ids=str)
def test_instances_equal_loop(spark, cfg):
    rnd = random.Random(str(cfg))
    series = {k: make(rnd, k, n, 0.985) for k, n in ((1, 700), (2, cfg.obs + cfg.lat), (3, cfg.obs + cfg.lat + 1), (4, 233), (5, 1))}
    unmatched = [(T0 + timedelta(minutes=12 * 300), "M1.0"), (T0 + timedelta(minutes=12 * 302 + 1), "X2.0")]
    df = spark.createDataFrame([r for s in series.values() for r in s], SCHEMA)
    um = spark.createDataFrame(unmatched, "peak_time timestamp_ntz, goes_class string")
    got = L.label_instances(L.window_frames(df, ["k"], "ts", cfg), um, cfg, ["k"]).collect()
    want = {(k, i): v for k, s in series.items() for i, v in loop(s, unmatched, cfg).items()}
    assert {(r.k, r.slice_pos): (r.obs_start, r.obs_end, r.outcome, r.label, r.reason) for r in got} == want
    assert len(got) == len(want)


def test_unit_folds_rows():
    assert L.WindowConfig().unit == 5
    assert L.WindowConfig(obs=10, lat=3, pred=7, step=2).unit == 1
