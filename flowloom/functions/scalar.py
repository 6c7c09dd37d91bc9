"""Column-level building blocks; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowloom import schema as S

NS = 1_000_000_000
_IPV4 = r"^(25[0-5]|2[0-4]\d|1?\d?\d)(\.(25[0-5]|2[0-4]\d|1?\d?\d)){3}$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def size_ns(size_s: float) -> int:
    """A window length in whole nanoseconds."""
    return int(round(size_s * NS))


def idiv(a: Column | str, n: int) -> Column:
    """Floor division of an integer column by a positive constant, exact on 64 bits."""
    a = col(a).cast("long")
    step = F.lit(n).cast("long")
    return F.call_function("div", a - F.pmod(a, step), step)


def window_id(ts_ns: Column | str = "ts_ns", size_s: float = 5.0) -> Column:
    """Number of the tumbling window a nanosecond time falls into."""
    return idiv(ts_ns, size_ns(size_s))


def ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    """``num / den`` as double, or ``default`` where ``den`` is zero or null."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(float(default)))


def clamp(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(float(low))), F.lit(float(high)))


def has_flag(mask: int, flags: Column | str = "tcp_flags") -> Column:
    return col(flags).bitwiseAND(F.lit(mask)) != 0


def flow_id(src_ip="src_ip", src_port="src_port", dst_ip="dst_ip", dst_port="dst_port", protocol="protocol") -> Column:
    """First eight hex digits of the md5 of ``src:sport->dst:dport:proto``."""
    text = F.concat(
        col(src_ip), F.lit(":"), col(src_port).cast("string"), F.lit("->"),
        col(dst_ip), F.lit(":"), col(dst_port).cast("string"), F.lit(":"), col(protocol).cast("string"),
    )
    return F.substring(F.md5(text), 1, 8)


def blocked_flow_id(src_ip: Column | str = "src_ip") -> Column:
    return F.substring(F.md5(F.concat(F.lit("BLOCKED_"), col(src_ip))), 1, 8)


def is_ipv4(text: Column | str) -> Column:
    """True for dotted IPv4 text, false for anything else including null."""
    return F.coalesce(col(text).rlike(_IPV4), F.lit(False))


def ip_to_long(text: Column | str) -> Column:
    """Dotted IPv4 text as a big-endian integer; null where the text is no address."""
    parts = F.split(col(text), r"\.")
    value = F.lit(0).cast("long")
    for i in range(4):
        value = value * 256 + F.try_element_at(parts, F.lit(i + 1)).try_cast("long")
    return F.when(is_ipv4(text), value)


def long_to_ip(number: Column | str) -> Column:
    """Big-endian integer as dotted IPv4 text."""
    n = col(number)
    octets = [F.shiftright(n, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *octets)


def state_name(state: Column | str) -> Column:
    out = F
    for key, name in S.CONN_STATES.items():
        out = out.when(col(state) == key, F.lit(name))
    return out.otherwise(F.lit("UNKNOWN"))


def l7_protocol(guard_dns: bool = False) -> Column:
    """Layer-7 id of a packet from its ports and the first bytes of its payload.

    ``guard_dns`` gives the stored value of collectors that only keep ids up to HTTPS, so
    that DNS comes out as unknown.
    """
    port = lambda p: (F.col("src_port") == p) | (F.col("dst_port") == p)
    head = F.coalesce(F.col("payload_prefix"), F.lit(""))
    enough = F.coalesce(F.col("payload_size") >= 5, F.lit(False))
    http = head.startswith("GET") | head.startswith("POST") | head.startswith("HTTP")
    dns = (F.col("protocol") == S.UDP) & port(53) & (F.col("payload_size") > 0)
    return (
        F.when(dns, F.lit(S.L7_UNKNOWN if guard_dns else S.L7_DNS))
        .when((F.col("protocol") == S.TCP) & enough & port(80) & http, F.lit(S.L7_HTTP))
        .when((F.col("protocol") == S.TCP) & enough & port(443), F.lit(S.L7_HTTPS))
        .otherwise(F.lit(S.L7_UNKNOWN))
    )


def endpoint_order() -> dict[str, Column]:
    """Undirected flow key: both endpoints in a fixed order, and the direction bit.

    ``dir`` is 0 where the source is the smaller endpoint.  Packets of the two directions
    of one conversation share the other four values.
    """
    src = F.struct(F.col("src_ip").alias("ip"), F.col("src_port").alias("port"))
    dst = F.struct(F.col("dst_ip").alias("ip"), F.col("dst_port").alias("port"))
    low, high = F.least(src, dst), F.greatest(src, dst)
    return {
        "ip_a": low["ip"], "port_a": low["port"], "ip_b": high["ip"], "port_b": high["port"],
        "dir": F.when(src <= dst, F.lit(0)).otherwise(F.lit(1)),
    }


#: Key columns :func:`endpoint_order` produces, with host and protocol.
CONVERSATION = ["host", "ip_a", "port_a", "ip_b", "port_b", "protocol"]
