"""Pairing of access requests with their responses.

The protocol allows one open request per flow (client, server, identifier). A newer request
replaces the open one and a response consumes it, so a response belongs to a request exactly when
the packet right before it in the flow is a request, at most the time limit earlier. That is one
``lag``, with no join and no over-matching on retransmissions.

Only packets within the time limit matter to each other. The flows are therefore cut into time
chunks, with the packets near a border repeated in the neighbouring chunk as context. One flow that
holds a large share of all packets is spread over as many tasks as there are chunks.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from accesslens import constants as C
from accesslens.functions import times
from accesslens.functions.keys import code_name, reply_reason
from accesslens.functions.text import blank_to_null
from accesslens.operators import decode, staging

_CHUNK_SECONDS = 300
_FLOW = ["client_ip", "client_port", "server_ip", "server_port", "packet_identifier"]
# What a packet is decoded from.
_PACKET = [
    "seq", "pkt_time", "code", "is_malformed", "packet_identifier", "packet_length", "src_ip", "dst_ip", "src_port",
    "dst_port", "payload",
]
_OVERRIDDEN_TEXTS = ["framed_ip", "framed_ip_netmask", "class_attr", "connect_info"]
_OVERRIDDEN_NUMBERS = ["service_type", "framed_protocol"]


def auth_packets(
    decoded: DataFrame, request: list[Column] | None = None, response: list[Column] | None = None
) -> DataFrame:
    """Requests and responses as one table of flow, time, and a struct for either role, of all its
    columns or of those given.

    A request comes from the client, so its source is the client; a response is the reverse. Both
    roles are cut out of one pass over the packets.
    """
    is_request = F.col("code") == C.ACCESS_REQUEST
    rows = decoded.filter(
        F.col("code").isin(C.ACCESS_REQUEST, *C.AUTH_RESPONSE_CODES) & ~F.col("is_malformed")
    )

    if request is None or response is None:
        rows = decode.walked(rows)

    def end(client: str, server: str) -> Column:
        return F.when(is_request, F.col(client)).otherwise(F.col(server))

    return rows.select(
        "seq", F.col("pkt_time").alias("at"), "packet_identifier",
        end("src_ip", "dst_ip").alias("client_ip"), end("src_port", "dst_port").alias("client_port"),
        end("dst_ip", "src_ip").alias("server_ip"), end("dst_port", "src_port").alias("server_port"),
        F.when(is_request, F.struct(*(request or decode.request_columns()))).alias("request"),
        F.when(~is_request, F.struct(*(response or decode.response_columns()))).alias("response"),
    )


def undecoded_packets(decoded: DataFrame) -> DataFrame:
    """:func:`auth_packets` with the packet itself in either role. Pairing needs headers only, so attributes can wait
    until it is known which packets are wanted."""
    packet = [F.col(c) for c in _PACKET]
    return auth_packets(decoded, packet, packet)


def auth_exchanges(
    packets: DataFrame, ttl_s: int = C.PAIRING_TTL_SECONDS, chunk_s: int = _CHUNK_SECONDS
) -> DataFrame:
    """Every request and response once, with ``matched`` (the request a response answers) and
    ``is_expired`` (no packet followed the request in its flow within the time limit)."""
    chunk_ms, ttl_ms = max(chunk_s, 2 * ttl_s) * 1000, ttl_s * 1000
    ms = times.epoch_ms(F.col("at"))
    placed = packets.withColumns({
        "home": F.floor(ms / chunk_ms).cast("bigint"), "offset": F.pmod(ms, F.lit(chunk_ms)),
    })
    near_end = F.when(F.col("offset") >= chunk_ms - ttl_ms, F.col("home") + 1)
    near_start = F.when(F.col("offset") <= ttl_ms, F.col("home") - 1)
    spread = placed.withColumn(
        "chunk", F.explode(F.array_compact(F.array("home", near_end, near_start)))
    )
    spread = staging.dealt(spread, *_FLOW, "chunk")
    order = Window.partitionBy(*_FLOW, "chunk").orderBy("at", "seq")
    limit = F.expr(f"INTERVAL {ttl_s} SECOND")
    previous, following = F.lag(F.struct("at", "request")).over(order), F.lead("at").over(order)
    seen = spread.withColumns({"previous": previous, "following": following})
    in_time = F.col("at") - F.col("previous.at") <= limit
    answers = F.col("response").isNotNull() & F.col("previous.request").isNotNull() & in_time
    followed = F.coalesce(F.col("following") - F.col("at") <= limit, F.lit(False))
    return seen.filter(F.col("chunk") == F.col("home")).select(
        "seq", "at", *_FLOW, "request", "response",
        F.when(answers, F.col("previous.request")).alias("matched"),
        (F.col("request").isNotNull() & ~followed).alias("is_expired"),
    )


def paired_records(exchanges: DataFrame) -> DataFrame:
    """Authentication records of the matched responses of :func:`undecoded_packets`. Attributes in the response win."""
    def packed(rows: DataFrame, name: str, other: str) -> DataFrame:
        return rows.select(other, F.struct(*[c for c in rows.columns if c != other]).alias(name))

    pairs = exchanges.filter("matched IS NOT NULL").select("response", "matched.*")
    pairs = packed(decode.as_requests(pairs, "response"), "matched", "response").select("matched", "response.*")
    return record_columns(packed(decode.as_responses(pairs, "matched"), "response", "matched").select("response.seq", "matched", "response"))


def record_columns(pairs: DataFrame) -> DataFrame:
    """Records from rows of ``seq``, the request ``matched`` and the ``response`` to it."""
    request, response = F.col("matched"), F.col("response")
    reason, risk = reply_reason(blank_to_null(response["reply_raw"]))
    from_request = [
        "username", "raw_username", "subscriber_id", "nas_ip", "nas_identifier", "nas_port",
        "nas_port_id", "nas_port_type", "calling_sta", "mac_addr", "called_sta",
        "packet_identifier", "src_port", "dst_port", "src_ip", "dst_ip", "req_ts",
    ]
    return pairs.select(
        "seq", *[request[c].alias(c) for c in from_request],
        *[F.coalesce(blank_to_null(response[c]), request[c]).alias(c) for c in _OVERRIDDEN_TEXTS],
        # A zero in the response counts as absent.
        *[
            F.coalesce(F.nullif(response[c], F.lit(0)), request[c]).alias(c)
            for c in _OVERRIDDEN_NUMBERS
        ],
        response["resp_ts"].alias("resp_ts"), response["result_code"].alias("result_code"),
        code_name(response["result_code"]).alias("result"),
        response["reply_raw"].alias("reply_raw"), reason.alias("reason_zh"), risk.alias("risk"),
        F.lit(True).alias("matched"),
    )


def pair_auth(decoded: DataFrame, ttl_s: int = C.PAIRING_TTL_SECONDS) -> DataFrame:
    return paired_records(auth_exchanges(undecoded_packets(decoded), ttl_s))


def unmatched_responses(decoded: DataFrame, ttl_s: int = C.PAIRING_TTL_SECONDS) -> DataFrame:
    """Responses with no open request."""
    rows = auth_exchanges(undecoded_packets(decoded), ttl_s)
    return decode.as_responses(rows.filter("response IS NOT NULL AND matched IS NULL").select("response.*"))


def expired_requests(decoded: DataFrame, ttl_s: int = C.PAIRING_TTL_SECONDS) -> DataFrame:
    """Requests whose flow stayed silent for the time limit."""
    rows = auth_exchanges(undecoded_packets(decoded), ttl_s)
    return decode.as_requests(rows.filter("is_expired").select("request.*"))
