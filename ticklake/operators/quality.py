"""Rules that ticks and their transactions must meet."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticklake.operators.parse import lower_hex, null_to_empty
from ticklake.operators.sequence import MAX_JUMP, STATE_FIELDS, sequence_state, sequence_step  # noqa: F401

# The limits and the critical rules.
MAX_TRANSACTIONS = 10_000
MAX_ITERATIONS = 1_000_000
FUTURE_LIMIT = timedelta(minutes=5)
PAST_LIMIT = timedelta(hours=24)
SIGNATURE_BYTES = 64
PUBLIC_KEY_BYTES = 32
CRITICAL_RULES = ["not_null", "sequence", "critical_hash_mismatch"]

# \z and not $, which in Java also matches before a final line break.
_HASH = r"\A[a-fA-F0-9]{64}\z"
_HEX = r"\A[a-fA-F0-9]+\z"
_ISSUE = "struct<field:string,value:string,rule:string,message:string>"


def _text(value: Column | str) -> Column:
    return F.lit(value) if isinstance(value, str) else value.cast("string")


def _issue(
    broken: Column, field: Column | str, rule: str, message: Column | str, value: Column | str = ""
) -> Column:
    """A struct describing the broken rule, or null."""
    return F.when(
        broken,
        F.struct(
            _text(field).alias("field"),
            _text(value).alias("value"),
            F.lit(rule).alias("rule"),
            _text(message).alias("message"),
        ),
    )


def _present(issues: list[Column]) -> Column:
    return F.filter(F.array(*issues), lambda issue: issue.isNotNull())


def _hash_issues(name: Column | str, value: Column, rule: str = _HASH) -> list[Column]:
    text = null_to_empty(value)
    what = "a 64-character" if rule == _HASH else "a valid"
    return [
        _issue(text == "", name, "not_empty", F.concat(_text(name), F.lit(" cannot be empty"))),
        _issue(
            (text != "") & ~text.rlike(rule),
            name,
            "hex_format",
            F.concat(
                _text(name),
                F.lit(f" must be {what} hexadecimal string (received length: "),
                F.octet_length(text).cast("string"),
                F.lit(")"),
            ),
            text,
        ),
    ]


def _micros(at: datetime) -> int:
    return (at - datetime(1970, 1, 1)) // timedelta(microseconds=1)


def timestamp_issues(timestamp: Column, now: datetime) -> Column:
    """Zero, or too far from ``now`` (UTC, without zone)."""
    given = F.coalesce(timestamp, F.lit(0))
    return _present(
        [
            _issue(given == 0, "timestamp", "not_zero", "timestamp cannot be zero", "0"),
            _issue(
                (given != 0) & (given > _micros(now + FUTURE_LIMIT)),
                "timestamp",
                "future_limit",
                F.concat(F.lit("timestamp "), given, F.lit(" is too far in the future")),
                given,
            ),
            _issue(
                (given != 0) & (given < _micros(now - PAST_LIMIT)),
                "timestamp",
                "past_limit",
                F.concat(F.lit("timestamp "), given, F.lit(" is too far in the past")),
                given,
            ),
        ]
    )


def proof_issues(proof: Column) -> Column:
    """Presence and shape of the proof; its mathematics are not checked."""
    iterations = F.coalesce(proof["iterations"], F.lit(0))
    parts = [
        *_hash_issues("vdf_input", proof["input"]),
        _issue(
            null_to_empty(proof["proof"]) == "",
            "vdf_proof.proof",
            "not_empty",
            "VDF proof data cannot be empty",
        ),
        _issue(
            iterations == 0, "vdf_proof.iterations", "positive",
            "VDF iterations must be positive", "0",
        ),
        _issue(
            iterations > MAX_ITERATIONS,
            "vdf_proof.iterations",
            "reasonable_limit",
            "VDF iterations seem unreasonably high",
            iterations,
        ),
    ]
    missing = _issue(F.lit(True), "vdf_proof", "not_null", "VDF proof is required")
    return F.when(proof.isNull(), F.array(missing)).otherwise(_present(parts))


def strict_issues(proof: Column, previous_output: Column) -> Column:
    """The rules for variable-length hexadecimal fields, which the main set leaves out."""
    output = [F.when(proof.isNotNull(), i) for i in _hash_issues("vdf_output", proof["output"], _HEX)]
    return _present([*output, *_hash_issues("previous_output", previous_output, _HEX)])


def _entry_issues(entry: Column, index: Column) -> Column:
    """Issues of one transaction entry, each with its place in the order of checks.
    Place 0 is left for the duplicate check, which needs the whole list."""

    def name(suffix: str) -> Column:
        return F.concat(F.lit("transactions["), index.cast("string"), F.lit("]" + suffix))

    body = entry["transaction"]
    here = entry.isNotNull()
    filled = here & body.isNotNull()

    def wrong_size(data: Column, size: int) -> Column:
        length = F.coalesce(F.octet_length(data), F.lit(0))
        return filled & (length > 0) & (length != size)

    def shortened(data: Column) -> Column:
        return F.concat(F.left(lower_hex(data), F.lit(20)), F.lit("..."))

    issues = [
        _issue(entry.isNull(), name(""), "not_null", "transaction cannot be nil"),
        *[F.when(here, i) for i in _hash_issues(name(".tx_hash"), entry["tx_hash"])],
        _issue(
            here & body.isNull(), name(".transaction"), "not_null",
            "transaction data cannot be nil",
        ),
        _issue(
            filled & (null_to_empty(body["tx_id"]) == ""), name(".tx_id"), "not_empty",
            "transaction ID cannot be empty",
        ),
        _issue(
            filled & (F.coalesce(F.octet_length(body["payload"]), F.lit(0)) == 0),
            name(".payload"), "not_empty", "transaction payload cannot be empty",
        ),
        _issue(
            wrong_size(body["signature"], SIGNATURE_BYTES), name(".signature"),
            "signature_format", "signature must be a valid hex string",
            shortened(body["signature"]),
        ),
        _issue(
            wrong_size(body["public_key"], PUBLIC_KEY_BYTES), name(".public_key"),
            "public_key_format", "public key must be a valid hex string",
            shortened(body["public_key"]),
        ),
        _issue(
            filled & (F.coalesce(body["timestamp"], F.lit(0)) == 0), name(".timestamp"),
            "positive", "transaction timestamp must be positive",
        ),
    ]
    placed = [
        F.struct(index.alias("at"), F.lit(k + 1).alias("k"), issue.alias("issue"))
        for k, issue in enumerate(issues)
    ]
    return F.filter(F.array(*placed), lambda p: p["issue"].isNotNull())


def _entry_is_broken(entry: Column) -> Column:
    """Whether an entry has any issue of its own: the same conditions, without the texts.
    Most entries have none, and for those this is all that is evaluated."""
    body = entry["transaction"]

    def sized(data: Column, size: int) -> Column:
        return F.coalesce(F.octet_length(data), F.lit(0)).isin(0, size)

    sound = (
        F.coalesce(entry["tx_hash"].rlike(_HASH), F.lit(False))
        & (null_to_empty(body["tx_id"]) != "")
        & (F.coalesce(F.octet_length(body["payload"]), F.lit(0)) > 0)
        & sized(body["signature"], SIGNATURE_BYTES)
        & sized(body["public_key"], PUBLIC_KEY_BYTES)
        & (F.coalesce(body["timestamp"], F.lit(0)) != 0)
    )
    return entry.isNull() | body.isNull() | ~sound


def _repeated_numbers(transactions: Column) -> Column:
    """Issues for the second and later uses of a sequence number in a tick.

    Sorting (number, position) pairs brings equal numbers together, so neighbours are
    compared once: n log n within the row, and no shuffle.
    """
    pairs = F.filter(
        F.transform(
            transactions,
            lambda entry, i: F.when(
                entry.isNotNull(),
                F.struct(
                    F.coalesce(entry["sequence_number"], F.lit(0)).alias("number"), i.alias("at")
                ),
            ),
        ),
        lambda pair: pair.isNotNull(),
    )
    ordered = F.sort_array(pairs)
    shared = F.greatest(F.array_size(ordered) - 1, F.lit(0))

    def duplicate(later: Column, earlier: Column) -> Column:
        issue = _issue(
            F.lit(True),
            F.concat(F.lit("transactions["), later["at"].cast("string"), F.lit("].sequence_number")),
            "unique",
            "duplicate sequence number in tick",
            later["number"],
        )
        return F.when(
            later["number"] == earlier["number"],
            F.struct(later["at"].alias("at"), F.lit(0).alias("k"), issue.alias("issue")),
        )

    found = F.zip_with(F.slice(ordered, 2, shared), F.slice(ordered, 1, shared), duplicate)
    return F.filter(found, lambda p: p.isNotNull())


def transaction_issues(transactions: Column) -> Column:
    """Issues of a tick's transactions, in the order of the list."""
    count = F.coalesce(F.array_size(transactions), F.lit(0))
    limit = _present(
        [
            _issue(
                count > MAX_TRANSACTIONS,
                "transactions",
                "count_limit",
                F.concat(
                    F.lit("transaction count "), count.cast("string"),
                    F.lit(f" exceeds maximum {MAX_TRANSACTIONS}"),
                ),
                count,
            )
        ]
    )
    found = F.transform(
        transactions,
        lambda entry, i: F.when(_entry_is_broken(entry), _entry_issues(entry, i)),
    )
    single = F.flatten(F.filter(found, lambda issues: issues.isNotNull()))
    placed = F.sort_array(F.concat(single, _repeated_numbers(transactions)))
    listed = F.coalesce(placed["issue"], F.array().cast(f"array<{_ISSUE}>"))
    return F.concat(limit, listed)


def is_sound(now: datetime, strict: bool = False) -> Column:
    """Whether a nested tick breaks no rule that needs no other tick: the conditions of
    ``tick_issues`` without places and texts, for about a fifth of the work."""
    proof, transactions = F.col("vdf_proof"), F.col("transactions")
    time = F.coalesce("timestamp", F.lit(0))
    numbers = F.transform(transactions, lambda e: F.coalesce(e["sequence_number"], F.lit(0)))
    conditions = [
        time.between(_micros(now - PAST_LIMIT), _micros(now + FUTURE_LIMIT)),
        time != 0,
        proof["input"].rlike(_HASH),
        proof["proof"] != "",
        proof["iterations"].between(1, MAX_ITERATIONS),
        F.coalesce(F.array_size(transactions) <= MAX_TRANSACTIONS, F.lit(True)),
        F.coalesce(~F.exists(transactions, _entry_is_broken), F.lit(True)),
        F.coalesce(
            F.array_size(F.array_distinct(numbers)) == F.array_size(numbers), F.lit(True)
        ),
    ]
    if strict:
        conditions += [proof["output"].rlike(_HEX), F.col("previous_output").rlike(_HEX)]
    sound = proof.isNotNull()
    for condition in conditions:
        sound = sound & F.coalesce(condition, F.lit(False))
    return sound


def lacks_parts() -> Column:
    """Whether a nested tick breaks a critical rule that needs no other tick: the proof, an
    entry or its transaction is null. Other critical rules are about the sequence."""
    part = F.exists("transactions", lambda e: e.isNull() | e["transaction"].isNull())
    return F.col("vdf_proof").isNull() | F.coalesce(part, F.lit(False))


def _none() -> Column:
    return F.array().cast(f"array<{_ISSUE}>")


def _stateless(now: datetime, strict: bool) -> tuple[Column, Column]:
    """Issues of the timestamp, and all that follow it, which sound ticks skip."""
    later = [proof_issues(F.col("vdf_proof"))]
    if strict:
        later.append(strict_issues(F.col("vdf_proof"), F.col("previous_output")))
    later.append(transaction_issues(F.col("transactions")))
    rest = F.when(is_sound(now, strict), _none()).otherwise(F.concat(*later))
    return timestamp_issues(F.col("timestamp"), now), rest


def tick_issues(ticks: DataFrame, now: datetime, strict: bool = False) -> DataFrame:
    """Ticks with ``issues``, all broken rules that need no other tick. A projection."""
    return ticks.withColumn("issues", F.concat(*_stateless(now, strict)))


def issue_rows(checked: DataFrame) -> DataFrame:
    """One row per issue, with its ``place`` in the tick.

    The outer form is on purpose: for the inner one Spark adds a filter on the size of
    the array below the projection, and all rules would be evaluated twice.
    """
    kept = [c for c in checked.columns if c != "issues"]
    rows = checked.select(*kept, F.posexplode_outer("issues").alias("place", "issue"))
    return rows.filter(F.col("issue").isNotNull()).select(*kept, "place", "issue.*")


# --- sequence rules -----------------------------------------------------------------


def sequence_issues(number: Column, time: Column, last: Column, last_time: Column) -> Column:
    """Broken sequence rules, given the last valid number and time (0 = none). The
    difference is unsigned, so going back breaks the jump limit as well."""
    backward = (last > 0) & (number <= last)
    jump = (last > 0) & ((number - last > MAX_JUMP) | (number < last))
    gap = F.when(number >= last, (number - last).cast("decimal(20,0)")).otherwise(
        (number - last).cast("decimal(20,0)") + F.lit("18446744073709551616").cast("decimal(20,0)")
    )
    return _present(
        [
            _issue(
                backward,
                "tick_number",
                "sequence",
                F.concat(
                    F.lit("tick number "), number.cast("string"),
                    F.lit(" is not greater than previous tick "), last.cast("string"),
                ),
                number,
            ),
            _issue(
                jump,
                "tick_number",
                "jump_limit",
                F.concat(
                    F.lit("tick number jump of "), gap.cast("decimal(20,0)").cast("string"),
                    F.lit(f" exceeds maximum allowed {MAX_JUMP}"),
                ),
                number,
            ),
        ]
    )


def time_sequence_issues(time: Column, last_time: Column) -> Column:
    return _present(
        [
            _issue(
                (time != 0) & (last_time > 0) & (time < last_time),
                "timestamp",
                "sequence",
                F.concat(
                    F.lit("timestamp goes backwards: "), time.cast("string"),
                    F.lit(" < "), last_time.cast("string"),
                ),
                time,
            )
        ]
    )


_SEQUENCE_COLUMNS = ["tick_number", "timestamp", "last_number", "last_time"]


def slim_ticks(ticks: DataFrame, now: datetime, strict: bool = False) -> DataFrame:
    """What the sequence rules need to know of each tick."""
    return ticks.select(
        "source_id",
        "arrival",
        F.coalesce("tick_number", F.lit(0)).alias("tick_number"),
        F.coalesce("timestamp", F.lit(0)).alias("timestamp"),
        is_sound(now, strict).alias("good"),
    )


def validate(
    ticks: DataFrame,
    now: datetime,
    strict: bool = False,
    slices: int | None = None,
) -> DataFrame:
    """Ticks with ``issues`` (all rules, in check order) and ``is_valid``.

    Only slim rows pass through the sequence fold; of those, only the ones that broke a
    rule are joined back, on the key (source_id, arrival).
    """
    state = sequence_state(slim_ticks(ticks, now, strict), slices)
    number = sequence_issues(*[F.col(c) for c in _SEQUENCE_COLUMNS])
    time = time_sequence_issues(F.col("timestamp"), F.col("last_time"))
    broken = state.select(
        "source_id", "arrival", number.alias("_number"), time.alias("_time")
    ).filter((F.array_size("_number") > 0) | (F.array_size("_time") > 0))
    none = _none()
    at_time, later = _stateless(now, strict)
    joined = ticks.join(broken, ["source_id", "arrival"], "left")
    issues = F.concat(
        F.coalesce("_number", none), at_time, F.coalesce("_time", none), later
    )
    return (
        joined.withColumn("issues", issues)
        .withColumn("is_valid", F.array_size("issues") == 0)
        .drop("_number", "_time")
    )


def is_critical(issues: Column | str = "issues") -> Column:
    """Whether an issue stops the tick; the others are warnings."""
    return F.exists(issues, lambda issue: issue["rule"].isin(CRITICAL_RULES))


def split_by_severity(checked: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean, warned and quarantined ticks."""
    critical, none = is_critical(), F.array_size("issues") == 0
    return (
        checked.filter(none),
        checked.filter(~none & ~critical),
        checked.filter(critical),
    )


def validation_stats(state: DataFrame) -> DataFrame:
    """Last valid tick, its time and the number of jumps, per source."""
    jump = (F.col("last_number") > 0) & (
        (F.col("tick_number") - F.col("last_number") > MAX_JUMP)
        | (F.col("tick_number") < F.col("last_number"))
    )
    place = F.when(F.col("accepted"), F.col("arrival"))
    return (
        state.groupBy("source_id")
        .agg(
            F.max_by("tick_number", place).alias("n"),
            F.max_by("timestamp", place).alias("t"),
            F.count_if(jump).alias("sequence_gaps"),
        )
        .select(
            "source_id",
            F.coalesce("n", F.lit(0)).alias("last_validated_tick"),
            F.timestamp_micros(F.coalesce("t", F.lit(0))).alias("last_validated_time"),
            "sequence_gaps",
        )
    )


# --- row predicates -----------------------------------------------------------------


def tick_row_is_valid() -> Column:
    return F.coalesce(
        (F.col("tick_number") > 0)
        & (F.col("timestamp_us") > 0)
        & (null_to_empty("transaction_batch_hash") != ""),
        F.lit(False),
    )


def transaction_row_is_valid() -> Column:
    filled = [
        F.coalesce(F.octet_length(c), F.lit(0)) > 0
        for c in ("tx_hash", "tx_id", "public_key", "signature")
    ]
    valid = F.col("tick_number") > 0
    for condition in filled:
        valid = valid & condition
    return F.coalesce(valid, F.lit(False))


def is_parseable() -> Column:
    return F.coalesce(F.col("tick_number") != 0, F.lit(False))
