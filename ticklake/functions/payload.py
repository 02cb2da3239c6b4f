"""Payload bytes to a readable value."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The protocol marker and the texts of decoded payloads.
PROTOCOL = "FRM_v1.0"
MARKER = "FRM_v1.0:"
BAD_HEX = "invalid hex encoding"
BAD_JSON = "invalid JSON in payload"


def _decoded(kind: str, **values: Column) -> Column:
    """A struct (kind, protocol, error, raw, data) with the given parts set."""
    types = {"protocol": "string", "error": "string", "raw": "string", "data": "variant"}
    parts = [
        values.get(name, F.lit(None)).cast(type_).alias(name) for name, type_ in types.items()
    ]
    return F.struct(F.lit(kind).alias("kind"), *parts)


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body mentions it.

    The body may use nothing but its argument: Spark resolves other column names in it
    against the aliases of the same select first.
    """
    return F.transform(F.array(value), body)[0]


def _parse(text: Column) -> Column:
    """JSON text (a bound value) as a variant, else null.

    Spark's parser ignores what follows the first value. In brackets such a rest is an
    error or a second element, unless it closes the bracket itself, and then it is an
    error in braces. Text that cannot begin a JSON value is not handed to the parser,
    which is slow to refuse.
    """

    def only_element(listed: Column) -> Column:
        in_braces = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
        whole = F.try_variant_get(listed, "$[1]", "variant").isNull() & (
            ~text.contains("]") | in_braces.isNotNull()
        )
        return F.when(whole, F.try_variant_get(listed, "$[0]", "variant"))

    in_brackets = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return F.when(
        text.rlike(r"\A[ \t\n\r]*[\[{\"\-0-9tfn]"), _bind(in_brackets, only_element)
    )


def decode_bytes(payload: Column) -> Column:
    """Decode stored payload bytes; null when empty.

    Kinds: ``protocol`` and ``protocol_error`` for the marked form, ``json`` for any JSON
    value, ``text`` for other text and ``binary`` for bytes that are not UTF-8 (kept as
    hexadecimal in ``raw``).
    """

    def marked(body: Column) -> Column:
        def classify(parsed: Column) -> Column:
            return F.when(
                parsed.isNotNull(), _decoded("protocol", protocol=F.lit(PROTOCOL), data=parsed)
            ).otherwise(
                _decoded(
                    "protocol_error", protocol=F.lit(PROTOCOL), error=F.lit(BAD_JSON), raw=body
                )
            )

        return _bind(_parse(body), classify)

    def plain(text: Column) -> Column:
        def classify(parsed: Column) -> Column:
            return F.when(parsed.isNotNull(), _decoded("json", data=parsed)).otherwise(
                _decoded("text", raw=text)
            )

        return _bind(_parse(text), classify)

    text = payload.cast("string")
    return (
        F.when(payload.isNull() | (F.octet_length(payload) == 0), None)
        .when(~F.is_valid_utf8(text), _decoded("binary", raw=F.lower(F.hex(payload))))
        .when(
            text.startswith(MARKER),
            _bind(F.substring(text, len(MARKER) + 1, 2147483647), marked),
        )
        .otherwise(_bind(text, plain))
    )


def decode_hex(payload_hex: Column) -> Column:
    """Decode a payload given in hexadecimal; bad digits give kind ``invalid_hex``."""
    good = payload_hex.rlike(r"\A([0-9a-fA-F]{2})*\z")
    return (
        F.when(payload_hex.isNull() | (payload_hex == ""), None)
        .when(~good, _decoded("invalid_hex", error=F.lit(BAD_HEX), raw=payload_hex))
        .otherwise(decode_bytes(F.unhex(payload_hex)))
    )


def decoded_json(decoded: Column) -> Column:
    """The decoded payload as one JSON document, comparable and groupable."""

    def document(**parts: Column) -> Column:
        return F.to_json(F.struct(*[c.alias(n) for n, c in sorted(parts.items())]))

    def render(d: Column) -> Column:
        kind, raw = d["kind"], d["raw"]
        return (
            F.when(kind == "json", F.to_json(d["data"]))
            .when(kind == "protocol", document(protocol=d["protocol"], data=d["data"]))
            .when(
                kind == "protocol_error",
                document(protocol=d["protocol"], error=d["error"], raw_json=raw),
            )
            .when(kind == "invalid_hex", document(error=d["error"], raw=raw))
            .when(kind.isin("text", "binary"), document(type=kind, data=raw))
        )

    return _bind(decoded, render)
