"""Secrets in whole texts: fixed patterns, and sliding-window entropy of candidate strings.

The place of a match is the sum of the lengths before it: splitting a text by a pattern and
extracting the pattern's matches give its parts in turn. A candidate string is read character by
character; the window's counts change by one character in and one out, and with them the
sum of n * log2(n), from which the window's Shannon entropy follows. The sum is kept in integers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from .common import prepare, text_or_empty

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
SCALE = 1 << 20
# Least bits per character of a window, by the characters it is made of: of random windows, 19 in 20 have more.
LEAST_BITS = {"hex": 3.0, "lower": 3.5, "upper": 3.45, "mixed": 3.75, "base64": 3.75}
# Maximal runs of these characters with a digit among them.
CANDIDATE = (r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
# Candidates that are known not to be secrets: UUIDs, numbers and times, runs of one character.
ALLOWED = (r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$", r"^[0-9/_=+-]+$", r"^(.)\1*$")
# Parts of a candidate, up to a slash or an equals sign, in which no window counts: alphabets in order, placeholders.
PART = r"[^/=]*[/=]?"
ALLOWED_PARTS = r"(?i)0123456789abcdef|abcdefghijklmnop|example|sample|dummy|placeholder|test"
MOST_SYMBOLS = 3  # of a base64 window
# Least changes between digits and others in a window: words with a number in them have two at most.
LEAST_CHANGES = {"lower": 3, "upper": 3, "mixed": 2, "base64": 2}


def _weights() -> list[int]:
    """n * log2(n), scaled, for n = 0, 1, ..."""
    return [0, 0] + [round(n * math.log2(n) * SCALE) for n in range(2, WINDOW + 1)]


def _limit(kind: str) -> int:
    """The largest sum at which a window still has the kind's least entropy."""
    return math.floor((WINDOW * math.log2(WINDOW) - WINDOW * LEAST_BITS[kind]) * SCALE)


def _places(text: Column, pattern: str, kind: int, values: Column | None = None, least: int = 0) -> Column:
    """Structs (start, kind, end, found) of all matches; of those whose `values` are long enough."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(found, found if values is None else values, lambda f, v: F.struct(f.alias("f"), v.alias("v")))
    pairs = F.zip_with(between, pairs, lambda b, p: F.struct(b.alias("b"), p["f"].alias("f"), p["v"].alias("v")))
    empty = F.array().cast("array<struct<start:bigint,kind:int,end:bigint,found:string>>")

    def step(done, pair):
        start = done["at"] + F.char_length(pair["b"])
        end = start + F.char_length(pair["f"])
        span = F.struct(start.cast("long").alias("start"), F.lit(kind).alias("kind"),
                        end.cast("long").alias("end"), pair["f"].alias("found"))
        wanted = pair["f"].isNotNull() & (F.char_length(pair["v"]) >= least)
        return F.struct(F.when(pair["f"].isNull(), start).otherwise(end).cast("long").alias("at"),
                        F.when(wanted, F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"))

    start = F.struct(F.lit(0).cast("long").alias("at"), empty.alias("spans"))
    spans = F.aggregate(pairs, start, step, lambda done: done["spans"])
    return F.when(F.rlike(text, F.lit(pattern)), spans).otherwise(empty)


def _kind_weight(char: Column) -> Column:
    """One, at the place of the character's kind; characters of no kind count nowhere."""
    out = None
    for place, (low, high) in enumerate((("0", "9"), ("a", "f"), ("g", "z"), ("A", "F"), ("G", "Z"))):
        one = F.lit(1 << (8 * place)).cast("long")
        out = F.when(char.between(low, high), one) if out is None else out.when(char.between(low, high), one)
    return out.when(F.instr(F.lit("+/=_-"), char) > 0, F.lit(1 << 40).cast("long")).otherwise(F.lit(0).cast("long"))


def _change_weight(char: Column, following: Column) -> Column:
    """One, at the place of the changes, if just one of two characters is a digit."""
    change = char.between("0", "9") != following.between("0", "9")
    return F.when(change, F.lit(1 << 48).cast("long")).otherwise(F.lit(0).cast("long"))


def _sum_limit(kinds: Column) -> Column:
    """The largest sum of weights at which a window of these kinds of characters is hot; -1 for none."""
    def n(place):
        return F.shiftright(kinds, 8 * place).bitwiseAND(F.lit(255))

    digits, lower, upper, symbols, changes = n(0), n(1) + n(2), n(3) + n(4), n(5), n(6)
    hexed = ((n(0) + n(1) == WINDOW) | (n(0) + n(3) == WINDOW)) & (digits < WINDOW)
    known = digits + lower + upper + symbols == WINDOW
    both = known & (lower >= 1) & (upper >= 1)

    def limit(kind):
        return F.when(changes >= LEAST_CHANGES[kind], _limit(kind)).otherwise(-1)

    return F.when(hexed, _limit("hex")).when(digits + lower == WINDOW, limit("lower")) \
        .when(digits + upper == WINDOW, limit("upper")).when(both & (symbols == 0), limit("mixed")) \
        .when(both & (symbols <= MOST_SYMBOLS), limit("base64")).otherwise(-1)


def _hot_window(candidate: Column) -> Column:
    """(first, last): where the first window of high entropy begins and the last one ends, or -1."""
    weights = F.array(*[F.lit(w).cast("long") for w in _weights()])
    zero = F.lit(0).cast("long")

    def count(window, char):
        return F.char_length(window) - F.char_length(F.replace(window, char, F.lit("")))

    def weight(n):
        return F.get(weights, n)

    def step(s, char):
        full = F.char_length(s["window"]) == WINDOW
        out = F.substring(s["window"], 1, 1)
        n_out = count(s["window"], out)
        less = F.when(full, weight(n_out - 1) - weight(n_out)).otherwise(zero)
        rest = F.when(full, F.substring(s["window"], 2, WINDOW)).otherwise(s["window"])
        n_in = count(rest, char)
        total = s["sum"] + less + weight(n_in + 1) - weight(n_in)
        gone = _kind_weight(out) + _change_weight(out, F.substring(s["window"], 2, 1))
        come = _kind_weight(char) + F.when(F.char_length(rest) > 0, _change_weight(F.right(rest, F.lit(1)), char)).otherwise(zero)
        kinds = s["kinds"] - F.when(full, gone).otherwise(zero) + come
        seen = s["seen"] + 1
        return F.struct(total.alias("sum"), kinds.alias("kinds"), F.concat(rest, char).alias("window"),
                        seen.alias("seen"), s["first"].alias("first"), s["last"].alias("last"))

    def judge(s):
        hot = (s["seen"] >= WINDOW) & (s["sum"] <= _sum_limit(s["kinds"]))
        return F.struct(
            s["sum"].alias("sum"), s["kinds"].alias("kinds"), s["window"].alias("window"), s["seen"].alias("seen"),
            F.when(hot & (s["first"] < 0), s["seen"] - WINDOW).otherwise(s["first"]).alias("first"),
            F.when(hot, s["seen"]).otherwise(s["last"]).alias("last"))

    start = F.struct(zero.alias("sum"), zero.alias("kinds"), F.lit("").alias("window"), F.lit(0).alias("seen"),
                     F.lit(-1).alias("first"), F.lit(-1).alias("last"))
    # Judging in a second lambda, bound to the stepped state, computes that state once.
    merged = F.aggregate(F.split(candidate, ""), start, lambda s, c: F.get(
        F.transform(F.array(step(s, c)), judge), F.lit(0)))
    return F.struct(merged["first"].alias("first"), merged["last"].alias("last"))


def _blanked(candidate: Column) -> Column:
    """The candidate with spaces, which are of no kind, instead of its allowed parts."""
    parts = F.regexp_extract_all(candidate, F.lit(PART), F.lit(0))
    blank = F.transform(parts, lambda p: F.when(
        F.rlike(p, F.lit(ALLOWED_PARTS)), F.repeat(F.lit(" "), F.char_length(p))).otherwise(p))
    return F.when(F.rlike(candidate, F.lit(ALLOWED_PARTS)), F.array_join(blank, "")).otherwise(candidate)


def _entropy_spans(text: Column) -> Column:
    places = _places(text, CANDIDATE, KINDS.index("entropy"))

    def known(c):
        out = F.lit(False)
        for pattern in ALLOWED:
            out = out | F.rlike(c["found"], F.lit(pattern))
        return out

    judged = F.transform(F.filter(places, lambda c: ~known(c)), lambda c: F.struct(
        c.alias("c"), _hot_window(_blanked(c["found"])).alias("w")))
    return F.transform(F.filter(judged, lambda j: j["w"]["first"] >= 0), lambda j: F.struct(
        (j["c"]["start"] + j["w"]["first"]).alias("start"), j["c"]["kind"].alias("kind"),
        (j["c"]["start"] + j["w"]["last"]).alias("end"), F.substring(
            j["c"]["found"], j["w"]["first"] + 1, j["w"]["last"] - j["w"]["first"]).alias("found")))


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id and `found`, an array of (start, kind, end, found) by start,
    then kind: 0 assign, 1 access, 2 hex, 3 entropy. Places count code points, the end excluded.

    Per kind, matches are leftmost and do not overlap. An entropy span reaches from the first
    window of WINDOW characters with high entropy in a candidate to the last; candidates on the
    allow-list give none, nor do windows that touch an allowed part of one. Kinds may overlap each other. Whole texts are read; a null text is
    empty and has none. Repeated rows and null ids are kept. An empty table gives no rows; other
    columns are ignored.
    """
    prepare(docs.sparkSession)
    text = F.col("_text")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("_text"))
    spans = F.concat(
        _places(text, ASSIGN, 0, F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)), ASSIGN_LEAST),
        _places(text, ACCESS, 1), _places(text, HEX, 2), _entropy_spans(text))
    return rows.select("doc_id", F.sort_array(spans).alias("found"))


def digests(found: DataFrame) -> DataFrame:
    """The columns of a report: counts and joined places of the rows of `find_secrets`."""
    names = F.array(*map(F.lit, KINDS))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")

    base = F.filter("found", lambda s: s["kind"] < KINDS.index("entropy"))
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))
