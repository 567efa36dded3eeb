"""Identity keys: stable hashes, session keys, code and reason names."""

from pyspark.sql import Column, DataFrame, functions as F

from accesslens.constants import CODE_NAMES, REPLY_REASONS, RISK_UNKNOWN
from accesslens.functions.text import blank_to_null, or_else, text


def stable_key(*parts: Column) -> Column:
    """SHA-256 over the parts joined by a unit separator; NULL is spelled out."""
    shown = [F.coalesce(p.cast("string"), F.lit("<NULL>")) for p in parts]
    return F.sha2(F.concat_ws("\u001f", *shown), 256)


def event_id(df: DataFrame) -> Column:
    """SHA-256 over all columns as JSON in name order, so equal records get equal ids."""
    ordered = F.struct(*[F.col(c) for c in sorted(df.columns)])
    return F.sha2(F.to_json(ordered, {"ignoreNullFields": "false"}), 256)


def counter_session_key(username: Column, nas_ip: Column, src_ip: Column, session: Column) -> Column:
    """Key of one cumulative counter: account, access server (or sender) and session id."""
    return F.concat_ws("|", text(username), text(or_else(nas_ip, src_ip)), text(session))


def dashboard_session_key(id_: Column, nas_ip: Column, session: Column) -> Column:
    """A row without a session id is a session of its own."""
    return F.when(
        blank_to_null(session).isNull(), F.concat(F.lit("event:"), id_.cast("string"))
    ).otherwise(F.concat_ws("|", text(nas_ip), session))


def _lookup(table: dict, c: Column) -> Column:
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), c)


def code_name(c: Column) -> Column:
    return F.coalesce(_lookup(CODE_NAMES, c.cast("int")), F.concat(F.lit("code="), c.cast("string")))


def reply_reason(c: Column) -> tuple[Column, Column]:
    """(reason, risk level) of a reply message; unknown messages pass through."""
    reason = {k: v[0] for k, v in REPLY_REASONS.items()}
    risk = {k: v[1] for k, v in REPLY_REASONS.items()}
    return (
        F.coalesce(_lookup(reason, c), blank_to_null(c)),
        F.coalesce(_lookup(risk, c), F.lit(RISK_UNKNOWN)),
    )
