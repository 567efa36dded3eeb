"""Frames encoded from the stand-in tables, for tests of the decoder and of pairing.

Encoding is plain SQL over the same rows the other fixtures use, so the decoded result is known.
"""

from pyspark.sql import DataFrame


def _byte(n: str) -> str:
    return f"unhex(lpad(hex({n}), 2, '0'))"


def _short(n: str) -> str:
    return f"unhex(lpad(hex({n}), 4, '0'))"


def _word(n: str) -> str:
    return f"unhex(lpad(hex({n}), 8, '0'))"


def _avp(kind: int, value: str, size: int | None = None) -> str:
    """``size`` spares working out a value of known length a second time."""
    length = f"length({value}) + 2" if size is None else str(size + 2)
    return f"concat({_byte(str(kind))}, {_byte(length)}, {value})"


def _text(kind: int, c: str) -> str:
    length = _byte(f"octet_length({c}) + 2")
    return f"coalesce(concat({_byte(str(kind))}, {length}, encode({c}, 'UTF-8')), X'')"


def _ip(c: str) -> str:
    return "concat(" + ", ".join(_byte(f"cast(split_part({c}, '.', {i}) AS INT)") for i in (1, 2, 3, 4)) + ")"


def _vsa(subtype: int, c: str) -> str:
    size, inner = _byte(f"octet_length({c}) + 2"), _byte(f"octet_length({c}) + 8")
    return (
        f"coalesce(concat({_byte('26')}, {inner}, {_word('2011')}, {_byte(str(subtype))}, {size}, "
        f"encode({c}, 'UTF-8')), X'')"
    )


def _payload(code: str, body: str) -> str:
    return f"concat({_byte(code)}, {_byte('identifier')}, {_short(f'length({body}) + 20')}, unhex(repeat('00', 16)), {body})"


# Bodies are columns of their own: a payload reads its body twice, and some payloads are sent twice.
_BODIES = {
    "request_body": [
        _text(1, "'stale'"), "user_avp", _avp(4, "nas_address", 4), _avp(5, _word("nas_port"), 4),
        _avp(61, _word("nas_port_type"), 4), _text(87, "nas_port_id"), _text(32, "nas_identifier"),
        "station_avp", _text(30, "called_sta"), _vsa(138, "username"), _vsa(153, "calling_sta"),
    ],
    "response_body": [
        _text(18, "nullif(reply_msg, '')"), f"if(result = 2, {_avp(8, 'framed_address', 4)}, X'')",
    ],
    "accounting_body": [
        "user_avp", _avp(4, "nas_address", 4), _avp(40, _word("acct_status_type"), 4),
        "session_avp", _avp(42, _word("input_octets"), 4), _avp(43, _word("output_octets"), 4),
        _avp(52, _word("input_gigawords"), 4), _avp(53, _word("output_gigawords"), 4),
        "station_avp", _avp(8, "framed_address", 4),
    ],
    "control_body": [
        _text(1, "username"), "session_avp", f"if(code IN (42, 45), {_avp(101, _word('503'), 4)}, X'')",
    ],
}


# kind -> (condition, seq, time, sent by the client?, client port, server port, payload).
# One request per authentication row with a known latency and its response, with anomalies: a
# retransmission when k % 10 = 1, no response when k % 13 = 0, a second one when k % 17 = 0.
# Every tenth accounting row also yields a control packet, going through all six codes. Accounting
# responses, an unknown code and cut packets complete the picture.
_MS = "INTERVAL '0.001' SECOND"
_SENT = "is_auth AND latency_ms IS NOT NULL"
_CONTROLLED = "NOT is_auth AND id % 10 = 0"
_KINDS = [
    (_SENT, "id * 8", f"req_ts - 50 * {_MS}", True, "auth_port", "1812", "request"),
    (f"{_SENT} AND k % 10 = 1", "id * 8 + 1", f"req_ts - 10 * {_MS}", True, "auth_port", "1812", "request"),
    (f"{_SENT} AND k % 13 <> 0", "id * 8 + 2", "ts", False, "auth_port", "1812", "response"),
    (
        f"{_SENT} AND k % 17 = 0 AND k % 13 <> 0", "id * 8 + 3", f"ts + 5 * {_MS}", False,
        "auth_port", "1812", "response",
    ),
    ("NOT is_auth", "id * 8", "ts", True, "auth_port", "1813", "accounting"),
    (_CONTROLLED, "id * 8 + 4", "ts", True, "51000", "3799", "control"),
    ("NOT is_auth AND id % 3 = 0", "id * 8 + 1", f"ts + 3 * {_MS}", False, "40000", "1813", _payload("5", "X''")),
    ("NOT is_auth AND id % 7 = 0", "id * 8 + 2", f"ts + 3 * {_MS}", False, "40000", "1813", _payload("12", "X''")),
    ("NOT is_auth AND id % 11 = 0", "id * 8 + 3", f"ts + 3 * {_MS}", False, "40000", "1813", "X'0401'"),
]
_SENT_WHEN = {"request": _SENT, "response": _SENT, "accounting": "NOT is_auth", "control": _CONTROLLED}
_CODES = {"request": "1", "response": "cast(result AS INT)", "accounting": "4", "control": "code"}


def _datagram(condition, seq, at, by_client, client_port, server_port, payload) -> str:
    ends = ("src_ip", "dst_ip") if by_client else ("dst_ip", "src_ip")
    addresses = ("src_address", "dst_address") if by_client else ("dst_address", "src_address")
    ports = (client_port, server_port) if by_client else (server_port, client_port)
    return f"""if({condition}, named_struct('seq', {seq}, 'pkt_time', {at},
      'src_ip', {ends[0]}, 'dst_ip', {ends[1]}, 'src_port', cast({ports[0]} AS INT),
      'dst_port', cast({ports[1]} AS INT), 'payload', {payload},
      'addresses', concat({addresses[0]}, {addresses[1]})), NULL)"""


def _listed(rows: DataFrame) -> DataFrame:
    """Datagrams with both addresses as bytes. Step by step, so that each piece is worked out once a row."""
    prepared = rows.selectExpr(
        "*", "id % 256 AS identifier", "cast(40000 + id % 4 AS INT) AS auth_port",
        "cast(40 + (id div 10) % 6 AS INT) AS code",
        *[f"{_ip(f'{c}_ip')} AS {c}_address" for c in ("src", "dst", "nas", "framed")],
        f"{_text(1, 'raw_username')} AS user_avp", f"{_text(31, 'calling_sta')} AS station_avp",
        f"{_text(44, 'acct_session_id')} AS session_avp",
    )
    bodies = prepared.selectExpr("*", *[
        f"if({_SENT_WHEN[name.removesuffix('_body')]}, concat({', '.join(parts)}), NULL) AS {name}"
        for name, parts in _BODIES.items()
    ])
    payloads = bodies.selectExpr("*", *[
        f"if({_SENT_WHEN[name]}, {_payload(code, f'{name}_body')}, NULL) AS {name}" for name, code in _CODES.items()
    ])
    packets = ", ".join(_datagram(*kind) for kind in _KINDS)
    # Packets that a row doesn't have come out as rows of nulls. Taking them out of the array beforehand would be a
    # function that Spark has no generated code for, and it would interpret the array, too.
    return payloads.selectExpr(f"inline(array({packets}))").filter("seq IS NOT NULL")


def datagrams(rows: DataFrame) -> DataFrame:
    """All packets of the rows of :func:`fixtures.all_rows`, in one pass."""
    return _listed(rows).drop("addresses")


def capture(rows: DataFrame) -> DataFrame:
    """Datagrams wrapped into UDP, IPv4 and a link header that depends on ``seq``."""
    udp = f"concat({_short('src_port')}, {_short('dst_port')}, {_short('length(payload) + 8')}, {_short('0')}, payload)"
    ip = (
        f"concat(X'4500', {_short('length(payload) + 28')}, X'000000004011', {_short('0')}, "
        f"addresses, {udp})"
    )
    wrapped = _listed(rows).selectExpr("seq", "pkt_time", f"{ip} AS ip", "seq div 8 % 5 AS kind")
    return wrapped.selectExpr(
        "seq", "pkt_time",
        "cast(CASE kind WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 101 WHEN 3 THEN 113 ELSE 276 END AS INT) AS link_type",
        """concat(CASE kind
          WHEN 0 THEN concat(unhex(repeat('02', 12)), X'0800')
          WHEN 1 THEN concat(unhex(repeat('02', 12)), X'88A800648100000A0800')
          WHEN 2 THEN X'' WHEN 3 THEN concat(unhex(repeat('00', 14)), X'0800')
          ELSE concat(X'0800', unhex(repeat('00', 18))) END, ip) AS frame""",
    )
