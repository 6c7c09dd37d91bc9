"""Hand-written packet lists for the edge cases of connection and window features."""

import random

import pytest
from pyspark.sql import functions as F

from flowloom import schema as S
from flowloom.operators import connections, extra, flows, packets
from flowloom.operators.flows import GROUP

BASE = dict(
    pkt_id=0, host="h", ts_ns=0, ifindex=0, src_mac=None, dst_mac=None, src_ip="10.0.0.1", dst_ip="10.0.0.2",
    src_port=1000, dst_port=80, protocol=6, ip_ttl=64, ip_tos=0, ip_id=1, ip_total_len=100, ip_header_len=20,
    tcp_header_len=20, udp_len=80, packet_size=100, tcp_flags=16, tcp_seq=1000, tcp_ack=1, tcp_window=1000,
    payload_prefix=None, dns_flags=0, icmp_type=0, icmp_code=0,
)


def make(spark, rows):
    full = [{**BASE, "pkt_id": i, **r} for i, r in enumerate(rows)]
    return packets.annotate_packets(spark.createDataFrame([tuple(r[n] for n in S.PACKETS.names) for r in full], S.PACKETS))


def one(spark, rows, **kw):
    out = flows.flow_features(make(spark, rows), **kw).collect()
    assert len(out) == 1
    return out[0]


S1 = 1_000_000_000


def test_single_packet(spark):
    row = one(spark, [{}])
    assert row.packet_count == 1 and row.inter_arrival_mean_ms == 0 and row.latency_p50 == 0
    assert row.packets_per_second == 0.2 and row.connection_state == "ESTABLISHED"


def test_window_without_valid_packet_gives_no_row(spark):
    assert flows.flow_features(make(spark, [{"packet_size": 0}, {"packet_size": 65536, "ts_ns": 1}])).count() == 0


def test_percentiles_need_two_gaps(spark):
    assert one(spark, [{"ts_ns": 0}, {"ts_ns": 10**6}]).latency_p50 == 0
    row = one(spark, [{"ts_ns": 0}, {"ts_ns": 10**6}, {"ts_ns": 4 * 10**6}])
    assert (row.latency_p50, row.latency_p95, row.latency_p99) == (3.0, 3.0, 3.0)


def test_retransmission_runs_break_at_exactly_one_second(spark):
    seqs = [5000, 4000, 3000, 2000]
    near = [{"tcp_seq": q, "ts_ns": i * (S1 - 1)} for i, q in enumerate(seqs)]
    far = [{"tcp_seq": q, "ts_ns": i * S1} for i, q in enumerate(seqs)]
    assert one(spark, near).consecutive_retrans == 3
    assert one(spark, far).consecutive_retrans == 1


def test_open_zero_window_adds_nothing(spark):
    wins = [(0, 10), (1, 0), (2, 0), (3, 10), (4, 0)]
    row = one(spark, [{"ts_ns": t * S1, "tcp_window": w} for t, w in wins])
    assert row.zero_window_duration == 2.0 and row.zero_window_count == 3 and row.tcp_window_drops == 2


def test_sequence_compare_is_unsigned_without_wrap(spark):
    top = 2**32 - 1
    rows = [{"tcp_seq": top, "ts_ns": 0}, {"tcp_seq": 1400, "ts_ns": 1}, {"tcp_seq": 1400, "ts_ns": 2}]
    got = connections.track_connections(make(spark, rows)).orderBy("pkt_id").collect()
    assert [r.retransmission for r in got] == [False, True, False]
    syn = [{"tcp_seq": top}, {"tcp_seq": 1500, "ts_ns": 1, "tcp_flags": 2}]
    second = connections.track_connections(make(spark, syn)).orderBy("pkt_id").collect()[1]
    assert not second.retransmission and second.out_of_order


def test_connection_states(spark):
    flags = [0, 0, 2, 17, 4, 16]
    rows = [{"ts_ns": i, "tcp_flags": f, "tcp_seq": 1000 + i} for i, f in enumerate(flags)]
    got = connections.track_connections(make(spark, rows)).orderBy("pkt_id").collect()
    assert [r.conn_state for r in got] == [2, 0, 1, 3, 3, 2]
    assert one(spark, rows[:2]).connection_state == "UNKNOWN"


def test_l7_mode_tie_goes_to_smallest(spark):
    web = {"payload_prefix": "GET /", "dst_port": 443, "src_port": 80}
    rows = [web, {**web, "ts_ns": 1, "payload_prefix": "XXXXX"}]
    assert one(spark, rows).l7_protocol == 1


def test_late_packet_lands_in_its_own_window(spark):
    rows = [{"ts_ns": 0}, {"ts_ns": 11 * S1}, {"ts_ns": 1}]
    got = {r.window_id: r.packet_count for r in flows.flow_features(make(spark, rows)).collect()}
    assert got == {0: 2, 2: 1}


def _busy(n=600):
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        hot = rnd.random() < 0.6
        rows.append(
            {
                "pkt_id": i,
                "ts_ns": rnd.randrange(0, 12 * S1, 1000),
                "src_port": 1000 if hot else 1000 + rnd.randrange(5),
                "tcp_seq": rnd.randrange(100_000),
                "tcp_window": rnd.choice([0, 0, 100, 500, 900]),
                "tcp_flags": rnd.choice([2, 16, 18, 17, 4, 24, 0]),
                "tcp_ack": rnd.randrange(3),
                "packet_size": rnd.choice([0, 40, 40, 60, 1500]),
                "ip_total_len": rnd.choice([40, 60, 1500]),
            }
        )
    rows += [{**rows[0], "pkt_id": n + i, "tcp_window": i % 2 * 7} for i in range(4)]
    return rows


@pytest.mark.parametrize("limit", [3, 40])
def test_cut_windows_give_the_same_rows(spark, limit):
    """Slices of crowded windows change nothing, for every ordered feature."""
    source = make(spark, _busy()).cache()
    for build in (flows.flow_features, extra.extra_packet_stats, extra.dup_acks):
        whole = {tuple(r[c] for c in GROUP): r.asDict() for r in build(source, max_rows=None).collect()}
        cut = {tuple(r[c] for c in GROUP): r.asDict() for r in build(source, max_rows=limit).collect()}
        assert whole.keys() == cut.keys()
        for key, row in whole.items():
            assert cut[key] == pytest.approx(row, nan_ok=True), key


def test_each_crowded_window_is_cut_by_its_own_count(spark):
    from flowloom.functions.ordered import split_hot_groups

    rows = make(spark, _busy())
    cut, block = split_hot_groups(rows, S.FLOW, 5.0, 2)
    sizes = cut.groupBy(*S.FLOW, "window_id", "crowded").count().collect()
    assert block == "slice_id" and sum(r["count"] for r in sizes) == rows.count()
    assert all(r["crowded"] == (r["count"] > 2) for r in sizes)
    assert cut.select("slice_id").distinct().count() > 20


def test_burst_at_one_instant_is_cut(spark):
    """Two bursts in one window: parts are small, and every ordered feature stays."""
    from flowloom.functions.ordered import split_hot_groups

    order = random.Random(5)
    rows = [{"ts_ns": t, "tcp_seq": order.randrange(1, 9) * 1000, "tcp_ack": order.randrange(2), "tcp_window": order.randrange(3)}
            for t in [0, 1, *[7] * 200, 8, *[2 * S1] * 100, 3 * S1, 7 * S1]]
    source = make(spark, rows).cache()
    cut, block = split_hot_groups(source, S.FLOW, 5.0, 20, tie="pkt_id")
    assert block == "part_id" and cut.count() == len(rows)
    assert cut.groupBy(block).count().agg(F.max("count")).first()[0] <= 20
    blocks = [r[0] for r in cut.orderBy(*S.ORDER).select(block).collect()]
    assert blocks == sorted(blocks)
    for build in (flows.flow_features, extra.extra_packet_stats, extra.dup_acks):
        whole, parts = ({r.window_id: r.asDict() for r in build(source, max_rows=n).collect()} for n in (None, 20))
        assert whole.keys() == parts.keys() == {0, 1}
        assert all(parts[w] == pytest.approx(row, nan_ok=True) for w, row in whole.items())


def test_tracking_over_packets_matches_python(spark):
    rows = sorted(_busy(), key=lambda r: (r["ts_ns"], r["pkt_id"]))
    last, want = {}, {}
    for r in rows:
        want[r["pkt_id"]] = last.get(r["src_port"])
        last[r["src_port"]] = r["tcp_seq"]
    got = connections.track_connections(make(spark, rows), max_rows=10)
    assert {r.pkt_id: r.prev_seq for r in got.select("pkt_id", "prev_seq").collect()} == want


def test_interface_copies_are_dropped(spark):
    rows = [{"ts_ns": t, "ifindex": i, "ip_id": 7 if i < 2 else 8} for i, t in enumerate((5, 3, 4))]
    kept = packets.dedup_interfaces(make(spark, rows))
    assert sorted(r.ts_ns for r in kept.collect()) == [3, 4]
    assert kept.columns == make(spark, rows).columns
    ms = 1_000_000
    # the identification comes round, a copy lies across a cell border, one interface repeats itself
    wrap = [{"ts_ns": t, "ifindex": i, "ip_id": 7} for t, i in ((ms - 1, 0), (ms + 5, 1), (2 * ms + 9, 0), (9 * ms, 1), (9 * ms + 3, 1))]
    assert sorted(r.ts_ns for r in packets.dedup_interfaces(make(spark, wrap)).collect()) == [ms - 1, 2 * ms + 9, 9 * ms, 9 * ms + 3]
    icmp = [{"ts_ns": 5 + i, "ifindex": i % 2, "protocol": 1, "ip_id": None} for i in range(50)]
    assert packets.dedup_interfaces(make(spark, icmp)).count() == 50


def test_preview_and_conform(spark):
    row = packets.conform(spark.range(1).select(F.lit("x").alias("flow_id")))
    assert row.columns == S.FEATURES.names and len(row.columns) == 94
    first = packets.preview(row).collect()[0]
    assert first.flow_id == "x" and first.anomaly_label == 0


def test_cuts_are_found_by_halving(spark):
    """The part of a row is the count of cuts up to it, without a look at each of them."""
    from flowloom.functions.ordered import MAX_PARTS, passed_cuts

    draw = random.Random(7)
    for n in (0, 1, 2, 31, 32, 33, 1022, 1023, 1500):
        cuts = sorted((draw.randrange(5), draw.randrange(400)) for _ in range(n))
        rows = [(draw.randrange(-1, 6), draw.randrange(-5, 405)) for _ in range(60)]
        source = spark.createDataFrame([(*r, cuts) for r in rows], "at long, tie long, cuts array<struct<at:long,tie:long>>")
        got = source.select("at", "tie", passed_cuts(F.col("cuts"), F.struct("at", "tie")).alias("n")).collect()
        assert all(r.n == min(sum(c <= (r["at"], r.tie) for c in cuts), MAX_PARTS - 1) for r in got)
