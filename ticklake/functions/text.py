"""Cleaning of free-text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space, escapes and patterns that are removed.
WHITE_SPACE = (
    "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    "\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
HTML_ESCAPES = [("&", "&amp;"), ("'", "&#39;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;")]
# Alternatives are put together by their first letters, which are looked at first: most places
# of a text begin none. "execute" loses its "exec", as it always comes first.
KEYWORDS = (
    "(?=[acdeijosu])(?:u(?:nion|pdate)|s(?:elect|cript)|insert|d(?:elete|rop)|create|alter|exec"
    "|javascript|on(?:load|error|click))"
)
MARKUP = r"(?=[<jo])(?:<script|<iframe|javascript:|on\w+=)"
TRAVERSAL = r"\.\.[\\/]|\.\.\\|%2e%2e|%252e%252e"
CONTROLS = r"[\p{Cc}&&[^\t\n\r]]"
MAX_BYTES = 10_000


def _cut(text: Column, max_bytes: int) -> Column:
    """The first bytes of a text. Each byte of a character cut in two becomes U+FFFD."""
    data = text.cast("binary")
    cut = F.substring(data, 1, max_bytes).cast("string")
    for torn in (3, 2, 1):
        whole = F.substring(data, 1, max_bytes - torn).cast("string")
        cut = F.when(
            F.is_valid_utf8(whole), F.concat(whole, F.lit("\ufffd" * torn))
        ).otherwise(cut)
    whole = F.substring(data, 1, max_bytes).cast("string")
    cut = F.when(F.is_valid_utf8(whole), whole).otherwise(cut)
    return F.when(F.octet_length(text) > max_bytes, cut).otherwise(text)


def sanitize(text: Column, max_bytes: int | None = None) -> Column:
    """Trim, limit, escape for HTML, then delete suspicious patterns and control characters.

    Whole texts are kept unless ``max_bytes`` (such as ``MAX_BYTES``) is given.
    """
    out = F.btrim(text, F.lit(WHITE_SPACE))
    if max_bytes is not None:
        out = _cut(out, max_bytes)
    for plain, escaped in HTML_ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    for pattern in (f"(?iu)({KEYWORDS})", f"(?iu)({MARKUP})", TRAVERSAL, CONTROLS):
        out = F.regexp_replace(out, pattern, "")
    return out


def sanitize_url_param(text: Column, max_bytes: int | None = None) -> Column:
    """As ``sanitize``, and without encoded null bytes."""
    return F.replace(sanitize(text, max_bytes), F.lit("%00"), F.lit(""))


def sanitize_json(text: Column, max_bytes: int | None = None) -> Column:
    """As ``sanitize``, and without script tags."""
    out = F.replace(sanitize(text, max_bytes), F.lit("</script>"), F.lit(""))
    return F.replace(out, F.lit("<script>"), F.lit(""))
