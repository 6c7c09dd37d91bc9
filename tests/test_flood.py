"""The rate gate against a packet-by-packet fold in plain Python."""

import random

import pytest

from flowloom.operators import flood

S1 = 1_000_000_000


def fold(rows, threshold, window=S1):
    state, blocked = {}, {}
    for src, ts, pkt in sorted(rows, key=lambda r: (r[1], r[2])):
        if src in blocked:
            continue
        if src not in state or ts - state[src][0] > window:
            state[src] = (ts, 1)
        elif state[src][1] + 1 > threshold:
            blocked[src] = (ts, pkt)
        else:
            state[src] = (state[src][0], state[src][1] + 1)
    return blocked


def table(spark, rows):
    return spark.createDataFrame([("h", s, t, p) for s, t, p in rows], "host string, src_ip string, ts_ns bigint, pkt_id bigint")


def got(spark, rows, threshold):
    return {r.src_ip: (r.block_ts, r.block_id) for r in flood.flood_blocklist(table(spark, rows), threshold).collect()}


def burst(seed, n, span, scale):
    rnd = random.Random(seed)
    at, rows = 0, []
    for i in range(n):
        at += int(rnd.expovariate(1) * scale) // 10_000_000 * 10_000_000
        if rnd.random() < 0.01:
            at += 3 * S1
        rows.append((f"s{rnd.randrange(span)}", at, i))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_blocklist_equals_fold(spark, seed):
    rows = burst(seed, 4000, 4, S1 // 30) + [(f"slow{seed}", i * 150 * S1 // 1000, 10_000 + i) for i in range(1500)]
    for threshold in (5, 9, 14):
        want = fold(rows, threshold)
        assert got(spark, rows, threshold) == want
        assert want and (threshold < 8 or f"slow{seed}" not in want)


def test_threshold_is_exceeded_by_packet_501(spark):
    at = [("a", i * 1000, i) for i in range(500)]
    assert got(spark, at, 500) == {}
    assert got(spark, [*at, ("a", S1, 500)], 500) == {"a": (S1, 500)}
    assert got(spark, [*at, ("a", S1 + 1, 500)], 500) == {}


def test_crowded_source_is_cut_exactly(spark):
    """Far more packets than the bound keeps, all at few instants."""
    rows = [("hot", 10 * S1 + (i // 900) * 100, i) for i in range(3000)] + [("hot", 9 * S1 + 5, 9999)]
    assert got(spark, rows, 20) == fold(rows, 20)


def test_window_over_piece_border(spark):
    border = flood.PIECE * S1
    rows = [("a", border - S1 // 2 + i * 50_000_000, i) for i in range(12)] + [("a", 1, 100)]
    assert got(spark, rows, 10) == fold(rows, 10)
    assert fold(rows, 10)


def test_blocked_rows_labels_and_repeats(spark):
    rows = [("a", i * 1000, i) for i in range(30)]
    blocklist = flood.flood_blocklist(table(spark, rows), 10)
    first = flood.blocked_rows(blocklist).collect()[0]
    assert (first.anomaly_label, first.packet_count, first.syn_count, first.syn_to_synack_ratio) == (2, 10, 10, 9999.0)
    again = flood.blocked_rows(blocklist, label_scheme="docs", repeat_every=30, end_ns=100 * S1).collect()
    assert len(again) == 4 and {r.anomaly_label for r in again} == {4}


def test_salted_lookup_equals_broadcast(spark):
    from flowloom.functions.sized import lookup_join

    big = spark.range(1000).selectExpr("id", "id % 7 AS k")
    small = spark.range(5).selectExpr("id AS k", "id * 10 AS v")
    rows = [sorted(map(tuple, lookup_join(big, small, ["k"], ["id"], limit=n).select("id", "k", "v").fillna(-1).collect())) for n in (100, 2)]
    assert rows[0] == rows[1] and len(rows[0]) == 1000


@pytest.mark.parametrize("piece,fan", [(1, 24), (3, 256)])
def test_pieces_compose_to_the_fold(spark, piece, fan):
    """Histories of hundreds of pieces, dense and sparse, with windows left open at every border."""
    rows = []
    for seed in range(6):
        rows += [(f"{seed}{s}", t, p) for s, t, p in burst(seed, 700, 2, S1 // (1 + 3 * seed))]
    rows += [("steady", i * S1 // 4, 50_000 + i) for i in range(1200)] + [("late", i * S1 // 4, 60_000 + i) for i in range(1200)]
    rows += [("late", 299 * S1 + 1, 70_000), ("alone", 5, 80_000)]
    for threshold in (4, 8):
        want = fold(rows, threshold)
        found = flood.flood_blocklist(table(spark, rows), threshold, piece=piece, fan=fan).collect()
        assert {r.src_ip: (r.block_ts, r.block_id) for r in found} == want and len(found) == len(want)
    assert "late" in fold(rows, 5) and "steady" not in fold(rows, 5)


def test_short_pieces_share_a_call():
    """Pieces of one bucket are solved a stretch at a time, each as it would be alone."""
    import pandas as pd

    rows = pd.DataFrame(sorted((t, p) for _, t, p in burst(3, 400, 1, S1 // 5)), columns=["ts_ns", "pkt_id"])
    rows["stretch"] = rows["ts_ns"] // (64 * S1)
    solve = flood._piece_outcomes(6, S1, 1)
    together = pd.concat([solve(("h", "a", key), part) for key, part in rows.groupby("stretch")])
    alone = pd.concat([solve(("h", "a", key), part) for key, part in rows.groupby(rows["ts_ns"] // S1)])
    assert len(together) > 50 and rows["stretch"].nunique() > 1
    flat = lambda df: [[x.tolist() if hasattr(x, "tolist") else x for x in r] for r in df.itertuples(index=False)]
    assert flat(together) == flat(alone)


def test_calls_follow_packets_not_time(spark):
    """A slow source over hours is solved in few calls; a call stays within the bound at any threshold."""
    rows = table(spark, [("a", i * 20 * S1 + j, i * 3 + j) for i in range(900) for j in range(3)])
    solved = flood.flood_blocklist(rows, 2)
    assert solved.count() == 1
    calls, outcomes = spark.sparkContext.accumulator(0), flood._piece_outcomes

    def counted(*given):
        solve = outcomes(*given)

        def one(key, pdf):
            calls.add(1)
            return solve(key, pdf)

        return one

    flood._piece_outcomes = counted
    try:
        assert flood.flood_blocklist(rows, 2).count() == 1 and flood.flood_blocklist(rows, 3).count() == 0
        steady = table(spark, [("a", i * 10 * S1 + j, i * 5 + j) for i in range(900) for j in range(5)])
        calls.value = 0
        assert flood.flood_blocklist(steady, 4).count() == 1 and 0 < calls.value <= 2
    finally:
        flood._piece_outcomes = outcomes
