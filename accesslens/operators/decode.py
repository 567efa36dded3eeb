"""Packet decoding as Catalyst expressions over a table of frames.

No Python runs per packet: frames, headers and attribute lists are taken apart with built-in binary
and higher-order functions, so decoding is a narrow, shuffle-free projection over the scan.

Expressions are SQL text. ``attrs`` and ``vsas`` list the attributes of a packet newest first, so
the first match is the last duplicate on the wire, which is the one that counts.
"""

from pyspark.sql import Column, DataFrame, functions as F

from accesslens import constants as C
from accesslens.functions import times
from accesslens.functions.keys import code_name
from accesslens.functions.text import normalize_mac, normalize_username, or_else, strip


def _uint_at(data: str, offset: str, width: int) -> str:
    """Big-endian unsigned integer at a zero-based offset; NULL past the end."""
    return f"cast(conv(hex(substring({data}, {offset} + 1, {width})), 16, 10) AS BIGINT)"


def _quad(data: str, offset: str) -> str:
    parts = ", ".join(f"cast({_uint_at(data, f'{offset} + {i}', 1)} AS STRING)" for i in range(4))
    return f"concat_ws('.', {parts})"


# --- Frames -----------------------------------------------------------------------------------

_VLAN = "(33024, 34984)"
_IPV4 = 2048
# Offset of the type field behind any number of VLAN tags.
_ETHER_TYPE_AT = f"""if({_uint_at('frame', '12', 2)} IN {_VLAN},
  aggregate(sequence(0, length(frame) div 4), 12,
    (at, i) -> if({_uint_at('frame', 'at', 2)} IN {_VLAN}, at + 4, at)), 12)"""


_IP_AT = f"""CASE WHEN link_type IN (101, 228) THEN 0
  WHEN link_type = 1 THEN get(transform(array({_ETHER_TYPE_AT}),
    at -> if({_uint_at('frame', 'at', 2)} = {_IPV4}, at + 2, NULL)), 0)
  WHEN link_type = 113 AND {_uint_at('frame', '14', 2)} = {_IPV4} THEN 16
  WHEN link_type = 276 AND length(frame) >= 20 AND {_uint_at('frame', '0', 2)} = {_IPV4} THEN 20
  END"""
# One-element lists that become empty at the first failed check: every intermediate result is
# computed once, and rows without a datagram vanish when the list is inlined.
_IP = f"""filter(transform(array({_IP_AT}), at -> substring(frame, at + 1)),
  ip -> length(ip) >= 20 AND {_uint_at('ip', '0', 1)} div 16 = 4
    AND {_uint_at('ip', '9', 1)} = 17 AND ({_uint_at('ip', '6', 2)} & 8191) = 0)"""
_UDP = f"""filter(transform({_IP}, ip -> named_struct('ip', ip,
    'udp', substring(ip, cast(({_uint_at('ip', '0', 1)} & 15) * 4 + 1 AS INT)))),
  d -> length(d.udp) >= 8 AND {_uint_at('d.udp', '4', 2)} BETWEEN 8 AND length(d.udp))"""
_DATAGRAM = f"""transform({_UDP}, d -> named_struct(
  'src_ip', {_quad('d.ip', '12')}, 'dst_ip', {_quad('d.ip', '16')},
  'src_port', cast({_uint_at('d.udp', '0', 2)} AS INT),
  'dst_port', cast({_uint_at('d.udp', '2', 2)} AS INT),
  'payload', substring(d.udp, 9, cast({_uint_at('d.udp', '4', 2)} AS INT) - 8)))"""


def extract_udp(packets: DataFrame) -> DataFrame:
    """Endpoints and payload of every complete, unfragmented IPv4 UDP datagram; others drop out.

    Link types: 1 Ethernet with VLAN tags, 101 and 228 raw IP, 113 and 276 Linux cooked capture.
    """
    found = packets.select("seq", "pkt_time", F.inline_outer(F.expr(_DATAGRAM)))
    # With the plain inline, Spark would add a filter that evaluates the whole list twice.
    return found.filter("payload IS NOT NULL")


def filter_ports(df: DataFrame, ports: list[int] | None = None) -> DataFrame:
    wanted = C.CAPTURE_PORTS if ports is None else ports
    return df.filter(F.col("src_port").isin(wanted) | F.col("dst_port").isin(wanted))


# --- Header and attributes --------------------------------------------------------------------


def decode_header(df: DataFrame) -> DataFrame:
    """Add code, identifier, declared length and ``is_malformed``."""
    fields = df.selectExpr(
        "*", f"cast({_uint_at('payload', '0', 1)} AS INT) AS code",
        f"cast({_uint_at('payload', '1', 1)} AS INT) AS packet_identifier",
        f"cast({_uint_at('payload', '2', 2)} AS INT) AS packet_length",
    )
    return fields.withColumn("is_malformed", F.expr(
        "length(payload) < 20 OR packet_length < 20 OR packet_length > length(payload)"
    ))


# Entries that the first pass over a list has room for; a second one, over what is left then, is mostly empty.
_FEW = 16


def _walk(data: str, start: int, entry: str, entry_type: str, least: int) -> str:
    """Fold over a type-length-value list that stops at the first bad length.

    ``start`` is the one-based position of the first entry's type byte and ``least`` the smallest
    valid length byte. The length of the next entry is read once and kept in the state. There are
    at most half as many entries as bytes, but mostly far fewer, and a fold can't end early: the
    first pass takes ``_FEW`` steps, the second as many as the bytes behind it can need.
    """
    length_at = f"coalesce(cast({_uint_at(data, '{at}', 1)} AS INT), 0)"
    going = f"s.len >= {least} AND s.pos + s.len - 1 <= length({data})"
    step = f"""(s, i) -> if({going},
        named_struct('pos', s.pos + s.len, 'len', {length_at.format(at='s.pos + s.len')},
          'out', array_prepend(s.out, {entry})),
        named_struct('pos', s.pos, 'len', 0, 'out', s.out))"""
    nothing = "cast(array() AS ARRAY<INT>)"
    first = f"""aggregate(
      if(length({data}) >= 2, sequence(1, least({_FEW}, length({data}) div 2)), {nothing}),
      named_struct('pos', {start}, 'len', {length_at.format(at=start)},
        'out', cast(array() AS ARRAY<{entry_type}>)), {step})"""
    return f"""get(transform(array({first}), s -> aggregate(
      if({going}, sequence(1, (length({data}) - s.pos + 1) div 2), {nothing}), s, {step}, s -> s.out)), 0)"""


_ATTR_TYPE = "STRUCT<t: INT, v: BINARY>"
_ATTR = f"""named_struct('t', cast({_uint_at('body', 's.pos - 1', 1)} AS INT),
  'v', substring(body, s.pos + 2, s.len - 2))"""
_VSA_TYPE = "STRUCT<vendor: BIGINT, subtype: INT, v: BINARY>"


def _vsa_walk() -> str:
    # A container is vendor id (4 bytes), then subtype, length and value; several may follow each
    # other, each with its own vendor id, so the step is the sub-length plus four.
    length_at = f"coalesce(cast({_uint_at('c.v', '{at}', 1)} AS INT), 0)"
    return f"""aggregate(
      if(length(c.v) >= 6, sequence(1, length(c.v) div 6), cast(array() AS ARRAY<INT>)),
      named_struct('pos', 1, 'len', {length_at.format(at=5)},
        'out', cast(array() AS ARRAY<{_VSA_TYPE}>)),
      (s, i) -> if(s.len >= 2 AND s.pos + 3 + s.len <= length(c.v),
        named_struct('pos', s.pos + 4 + s.len, 'len', {length_at.format(at='s.pos + s.len + 8')},
          'out', array_prepend(s.out, named_struct(
            'vendor', {_uint_at('c.v', 's.pos - 1', 4)},
            'subtype', cast({_uint_at('c.v', 's.pos + 3', 1)} AS INT),
            'v', substring(c.v, s.pos + 6, s.len - 2)))),
        named_struct('pos', s.pos, 'len', 0, 'out', s.out)),
      s -> s.out)"""


def _with_walked(df: DataFrame, name: str, walk: str) -> DataFrame:
    """Add a list column that is computed exactly once.

    As a plain column the walk would be copied into every filter on a decoded attribute that Spark
    pushes down. The output of a generator is not.
    """
    return df.select("*", F.inline_outer(F.array(F.struct(F.expr(walk).alias(name)))))


def decode_attributes(df: DataFrame) -> DataFrame:
    """Add ``attrs``, the (type, value) list of each well-formed packet, newest first."""
    body = df.withColumn(
        "body", F.expr("if(is_malformed, X'', substring(payload, 21, packet_length - 20))")
    )
    return _with_walked(body, "attrs", _walk("body", 1, _ATTR, _ATTR_TYPE, 2)).drop("body")


def decode_vsa(df: DataFrame) -> DataFrame:
    """Add ``vsas``, the vendor sub-attributes of all containers of the packet, newest first."""
    containers = f"filter(attrs, a -> a.t = {C.ATTR_VENDOR_SPECIFIC})"
    return _with_walked(df, "vsas", f"flatten(transform({containers}, c -> {_vsa_walk()}))")


def _value(attr: int) -> str:
    return f"get(attrs.v, array_position(attrs.t, {attr}) - 1)"


def _as_text(value: str) -> str:
    text = f"make_valid_utf8(cast({value} AS STRING))"
    return rf"if(instr({text}, '\0') > 0, regexp_replace({text}, '^\\x00+|\\x00+$', ''), {text})"


def attr_text(attr: int) -> Column:
    """Text attribute without surrounding NUL bytes; broken UTF-8 is replaced."""
    return F.expr(_as_text(_value(attr)))


def attr_ip(attr: int) -> Column:
    """Dotted quad of a four-byte attribute, lower-case hex of any other length."""
    v = _value(attr)
    return F.expr(f"if(length({v}) = 4, {_quad(v, '0')}, lower(hex({v})))")


def attr_uint(attr: int) -> Column:
    """Four-byte unsigned attribute; NULL for any other length."""
    v = _value(attr)
    return F.expr(f"if(length({v}) = 4, {_uint_at(v, '0', 4)}, NULL)")


def _vsa_value(vendor: int, subtype: int) -> str:
    return (
        f"get(filter(vsas, a -> a.vendor = {vendor} AND a.subtype = {subtype}), 0).v"
    )


def vsa_text(vendor: int, subtype: int) -> Column:
    """Vendor text up to the first NUL byte, stripped; empty when absent."""
    v = F.expr(f"make_valid_utf8(cast({_vsa_value(vendor, subtype)} AS STRING))")
    return F.coalesce(strip(F.split_part(v, F.lit("\0"), F.lit(1))), F.lit(""))


def vsa_uint(vendor: int, subtype: int) -> Column:
    """First four bytes of a vendor value as unsigned integer; 0 when there are fewer."""
    v = _vsa_value(vendor, subtype)
    return F.expr(f"if(length({v}) >= 4, {_uint_at(v, '0', 4)}, 0L)")


# --- Records ----------------------------------------------------------------------------------

_TEXTS = {
    "nas_identifier": C.ATTR_NAS_IDENTIFIER, "nas_port_id": C.ATTR_NAS_PORT_ID,
    "calling_sta": C.ATTR_CALLING_STATION, "called_sta": C.ATTR_CALLED_STATION,
    "class_attr": C.ATTR_CLASS, "connect_info": C.ATTR_CONNECT_INFO,
}
_ADDRESSES = {
    "framed_ip": C.ATTR_FRAMED_IP, "framed_ip_netmask": C.ATTR_FRAMED_IP_NETMASK,
}
_NUMBERS = {
    "nas_port": C.ATTR_NAS_PORT, "nas_port_type": C.ATTR_NAS_PORT_TYPE,
    "service_type": C.ATTR_SERVICE_TYPE, "framed_protocol": C.ATTR_FRAMED_PROTOCOL,
}
_ACCT_TEXTS = {
    "acct_session_id": C.ATTR_ACCT_SESSION_ID,
    "acct_multi_session_id": C.ATTR_ACCT_MULTI_SESSION_ID,
}
_ACCT_NUMBERS = {
    "acct_status_type": C.ATTR_ACCT_STATUS_TYPE, "acct_authentic": C.ATTR_ACCT_AUTHENTIC,
    "acct_session_time": C.ATTR_ACCT_SESSION_TIME, "input_octets": C.ATTR_ACCT_INPUT_OCTETS,
    "input_gigawords": C.ATTR_ACCT_INPUT_GIGAWORDS, "output_octets": C.ATTR_ACCT_OUTPUT_OCTETS,
    "output_gigawords": C.ATTR_ACCT_OUTPUT_GIGAWORDS,
    "input_packets": C.ATTR_ACCT_INPUT_PACKETS, "output_packets": C.ATTR_ACCT_OUTPUT_PACKETS,
    "terminate_cause": C.ATTR_ACCT_TERMINATE_CAUSE, "acct_delay_time": C.ATTR_ACCT_DELAY_TIME,
    "event_timestamp": C.ATTR_EVENT_TIMESTAMP,
}
_ENDPOINTS = ["packet_identifier", "src_ip", "dst_ip", "src_port", "dst_port"]


def decode_packets(datagrams: DataFrame) -> DataFrame:
    """Header, attributes and vendor sub-attributes of every datagram."""
    return decode_vsa(decode_attributes(decode_header(datagrams)))


def walked(packets: DataFrame) -> DataFrame:
    """Packets with the lists of their attributes, whether they had them or only a header."""
    return packets if "attrs" in packets.columns else decode_vsa(decode_attributes(packets))


def _identity(fallback_ip: Column) -> list[Column]:
    raw = F.coalesce(attr_text(C.ATTR_USER_NAME), F.lit(""))
    subscriber = vsa_text(C.VENDOR_ID, C.VSA_SUBSCRIBER_ID)
    mac = vsa_text(C.VENDOR_ID, C.VSA_MAC_ADDRESS)
    return [
        normalize_username(F.coalesce(or_else(raw, subscriber), F.lit(""))).alias("username"),
        raw.alias("raw_username"), subscriber.alias("subscriber_id"),
        F.coalesce(or_else(attr_ip(C.ATTR_NAS_IP)), fallback_ip).alias("nas_ip"),
        normalize_mac(or_else(mac, attr_text(C.ATTR_CALLING_STATION))).alias("mac_addr"),
    ]


IDENTITY = ["username", "raw_username", "subscriber_id", "nas_ip", "mac_addr"]


def with_identity(rows: DataFrame, fallback_ip: Column) -> DataFrame:
    """Add who and where, worked out in a projection, which shares common parts, and then passed
    through a generator: accounting and control records are filtered on the account name, and the
    filter would otherwise repeat the most expensive column."""
    columns = dict(zip(IDENTITY, _identity(fallback_ip)))
    found = rows.select("*", *[c.alias(f"found_{n}") for n, c in columns.items()])
    passed = F.struct(*[F.col(f"found_{n}").alias(n) for n in columns])
    return found.select(*rows.columns, F.inline_outer(F.array(passed)))


def _common() -> list[Column]:
    return [
        *[attr_text(a).alias(n) for n, a in _TEXTS.items()],
        *[attr_ip(a).alias(n) for n, a in _ADDRESSES.items()],
        *[attr_uint(a).alias(n) for n, a in _NUMBERS.items()],
    ]


def request_columns() -> list[Column]:
    return [
        F.col("seq"), times.to_ms_precision(F.col("pkt_time")).alias("req_ts"), *_identity(F.col("src_ip")), *_common(),
        *[F.col(c) for c in _ENDPOINTS],
    ]


def response_columns() -> list[Column]:
    return [
        F.col("seq"), times.to_ms_precision(F.col("pkt_time")).alias("resp_ts"), F.col("code").alias("result_code"),
        F.coalesce(attr_text(C.ATTR_REPLY_MESSAGE), F.lit("")).alias("reply_raw"), *_common(),
        *[F.col(c) for c in _ENDPOINTS],
    ]


def project_request(decoded: DataFrame) -> DataFrame:
    """Access requests with their identity and access attributes."""
    return as_requests(decoded.filter(f"NOT is_malformed AND code = {C.ACCESS_REQUEST}"))


def as_requests(packets: DataFrame, *also: str) -> DataFrame:
    """Rows that are access requests, as :func:`request_columns`, behind the columns named in ``also``."""
    found = with_identity(walked(packets), F.col("src_ip"))
    return found.select(
        *also, "seq", times.to_ms_precision(F.col("pkt_time")).alias("req_ts"), *IDENTITY, *_common(), *_ENDPOINTS,
    )


def project_response(decoded: DataFrame) -> DataFrame:
    """Access responses (accept, reject, challenge) with the attributes that may override the request."""
    return as_responses(decoded.filter(F.col("code").isin(C.AUTH_RESPONSE_CODES) & ~F.col("is_malformed")))


def as_responses(packets: DataFrame, *also: str) -> DataFrame:
    """Rows that are access responses, as :func:`response_columns`, behind the columns named in ``also``."""
    return walked(packets).select(*also, *response_columns())


def project_accounting(decoded: DataFrame) -> DataFrame:
    """Accounting requests."""
    rows = decoded.filter(f"NOT is_malformed AND code = {C.ACCOUNTING_REQUEST}")
    return with_identity(walked(rows), F.col("src_ip")).select(
        "seq", F.lit("accounting").alias("record_type"), *IDENTITY, *_common(),
        *[attr_text(a).alias(n) for n, a in _ACCT_TEXTS.items()],
        *[attr_uint(a).alias(n) for n, a in _ACCT_NUMBERS.items()],
        vsa_uint(C.VENDOR_ID, C.VSA_INPUT_AVERAGE_RATE).alias("input_average_rate"),
        vsa_uint(C.VENDOR_ID, C.VSA_OUTPUT_AVERAGE_RATE).alias("output_average_rate"),
        vsa_text(C.VENDOR_ID, C.VSA_PRODUCT_ID).alias("product_id"), *_ENDPOINTS,
        times.to_ms_precision(F.col("pkt_time")).alias("ts"),
    )


def access_server() -> Column:
    """The end of a packet that is the access server: control requests travel towards it."""
    return F.when(F.col("code").isin(40, 43), F.col("dst_ip")).otherwise(F.col("src_ip"))


def project_control(decoded: DataFrame) -> DataFrame:
    """Disconnect and change-of-authorization packets.

    Requests of this kind travel towards the access server, answers come from it.
    """
    rows = decoded.filter(F.col("code").isin(C.CONTROL_CODES) & ~F.col("is_malformed"))
    return with_identity(walked(rows), access_server()).select(
        "seq", F.lit("control").alias("record_type"), *IDENTITY, *_common(),
        *[attr_text(a).alias(n) for n, a in _ACCT_TEXTS.items()],
        attr_uint(C.ATTR_ERROR_CAUSE).alias("error_cause"),
        attr_uint(C.ATTR_EVENT_TIMESTAMP).alias("event_timestamp"),
        F.col("code").alias("result_code"), code_name(F.col("code")).alias("result"), *_ENDPOINTS,
        times.to_ms_precision(F.col("pkt_time")).alias("ts"),
    )
