"""Personal data: proposed by patterns, confirmed by checksums, scored by context.

1. A regular expression per kind proposes spans, leftmost first and without overlap
   inside a kind. A match that its validator rejects is dropped and not tried again.
   Bank accounts are looked for from every word that can begin one instead, and end where
   a word ends: of the ends that pass mod-97 the one at the length of the country counts,
   or else the last. So two may overlap, where one is found inside another.
2. Validators: parts of an address up to 255, Luhn for cards, mod-97 for bank accounts,
   a number of digits for phones.
3. A score from 0 to 100: what the kind is worth, plus what a confirming checksum adds,
   plus what a context word in the code points before the span adds. Base kinds (email,
   ip, card, phone) always stay; the kinds that the method adds (iban, ssn) stay from
   THRESHOLD on, so an ssn counts only next to a word that names it. For these, a word in
   as many code points after the span counts as well.

Positions come from the pieces between the matches, so a text is matched twice at most
per kind, and only once if nothing matches. All quantifiers that could backtrack over a
long run are possessive and start only where a run starts: very long texts take time in
proportion to their length.

Defined cases: a NULL text is empty; empty texts have no spans; offsets are code points,
the end exclusive; repeated rows each give a row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import free_name, has_columns

CONTEXT_CHARS = 40
CONTEXT_SCORE = 30
THRESHOLD = 60
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
SSN_CHARS = 11


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    score: int  # of a match that its validator accepts
    context: str  # words near a span that speak for it
    base: bool  # base kinds stay whatever their score


_LOCAL = "A-Za-z0-9._%+-"
# what may not stand directly before or after an account; other scripts have no spaces
_ALNUM = r"[\p{IsLatin}\p{Nd}]"
_HEAD = r"[A-Z]{2}[0-9]{2}"
HEAD_CHARS = 4
# code points without spaces
ACCOUNT_MIN, ACCOUNT_MAX = 15, 34
# as far as the last word's end
_ACCOUNT = rf"^{_HEAD}(?:\x20?[A-Z0-9]){{{ACCOUNT_MIN - HEAD_CHARS},{ACCOUNT_MAX - HEAD_CHARS}}}(?!{_ALNUM})"
# spaces before all but the head's code points, and the context that follows
_STRETCH = 2 * ACCOUNT_MAX - HEAD_CHARS + CONTEXT_CHARS
ACCOUNT_CHARS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
KINDS = (
    Kind(
        "email",
        # a run of these characters can only start a match where it starts, or where the last match ended
        rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        70,
        "mail|contact|write",
        True,
    ),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 60, "ip|address|host|server", True),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", 70, "card|visa|credit|pay", True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 60, "phone|tel|call|mobile|fax", True),
    Kind(
        "iban",
        # matches the head alone, so that a later word may begin an account too; the group is what may belong
        # to it and the context behind
        rf"(?:(?<!{_ALNUM})|(?<=(?i:iban)))"
        rf"(?=({_HEAD}(?:\x20?[A-Z0-9]){{{ACCOUNT_MIN - HEAD_CHARS}}}(?s:.{{0,{_STRETCH - ACCOUNT_MIN}}}))){_HEAD}",
        70,
        "iban|account|bank",
        False,
    ),
    Kind(
        "ssn",
        # the group is the number and the context behind it
        rf"(?=({_SSN}(?s:.{{0,{CONTEXT_CHARS}}}))){_SSN}",
        30,
        "ssn|social security|tax id",
        False,
    ),
)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the last digit of a string of digits is the right check digit."""

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - place + 1, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number without spaces leaves 1 when divided by 97."""
    moved = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))

    def step(rest: Column, place: Column) -> Column:
        code = F.ascii(F.substring(moved, place, F.lit(1)))
        return F.when(code >= 65, rest * 100 + code - 55).otherwise(rest * 10 + code - 48) % 97

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def account(stretch: Column) -> Column:
    """The account number that a text begins with, or NULL."""
    lengths = F.create_map(*[F.lit(x) for n, codes in ACCOUNT_CHARS.items() for code in codes.split() for x in (code, n)])

    def plain(part: Column) -> Column:
        return F.replace(part, F.lit(" "), F.lit(""))

    def beginnings(words: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(words)), lambda n: F.array_join(F.slice(words, F.lit(1), n), " "))

    def best(valid: Column) -> Column:
        of_country = F.filter(valid, lambda part: F.length(plain(part)) == F.try_element_at(lengths, F.left(part, F.lit(2))))
        return F.coalesce(F.get(of_country, F.lit(0)), F.get(valid, F.size(valid) - 1))

    words = F.split(F.regexp_extract(stretch, _ACCOUNT, 0), " ")
    return _bound(
        F.filter(
            _bound(words, beginnings),
            lambda part: F.when(F.length(plain(part)) >= ACCOUNT_MIN, mod97(plain(part))).otherwise(False),
        ),
        best,
    )


def _valid(kind: str, match: Column) -> Column:
    n_digits = F.length(_digits(match))
    if kind == "ip":
        # leading zeros may make a part long: drop them, then up to 255 in three digits
        return F.forall(
            F.split(match, r"\."),
            lambda part: (F.length(F.ltrim(part, F.lit("0"))) <= 3)
            & (F.substring(F.concat(F.lit("000"), F.ltrim(part, F.lit("0"))), -3, 3) <= "255"),
        )
    if kind == "card":
        return F.when(n_digits.between(13, 19), luhn(_digits(match))).otherwise(False)
    if kind == "phone":
        return n_digits.between(9, 15)
    return match.isNotNull()


SPAN = "struct<kind:string,start:int,end:int,score:int>"
# matches, or spans, that are gone through one after the other; appending to an array or a
# text copies it, so what is appended to stays this short
BLOCK = 256


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _by_blocks(
    items: Column, measure: Callable[[Column], Column], merge: Callable, run: Callable[[Column, Column], Column]
) -> Column:
    """An array of what ``run`` makes of each BLOCK of items, given the position at its start:
    0, merged with the measures of all blocks before."""

    def blocks(bound: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(bound) - 1) / BLOCK).cast("int"))
        parts = F.transform(numbers, lambda n: F.slice(bound, n * BLOCK + 1, F.lit(BLOCK)))
        sizes = F.transform(parts, measure)
        starts = F.aggregate(
            sizes,
            F.array(F.lit(0)),
            lambda found, size: F.concat(found, F.array(merge(F.element_at(found, -1), size))),
        )
        # the last start is the end of everything, and has no part
        pairs = F.arrays_zip(parts.alias("part"), F.slice(starts, F.lit(1), F.size(parts)).alias("start"))
        return F.transform(pairs, lambda z: run(z["part"], z["start"]))

    return _bound(items, blocks)


def _spans_of(kind: Kind, text: Column) -> Column:
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0 if kind.base else 1))
    none = F.array().cast(f"array<{SPAN}>")

    def head(pair: Column) -> Column:
        """What the pattern matched: where the next piece between matches begins."""
        return pair["match"] if kind.base else F.left(pair["match"], F.lit(HEAD_CHARS if kind.name == "iban" else SSN_CHARS))

    def take(state: Column, pair: Column) -> Column:
        if kind.name == "iban":
            return _bound(account(pair["match"]), lambda match: taken(state, pair, match))
        return taken(state, pair, head(pair))

    def taken(state: Column, pair: Column, match: Column) -> Column:
        start = state["pos"] + F.length(pair["before"])
        end = start + F.length(match)
        # the text just before is carried along: finding a place in a text takes its length
        near = F.right(F.concat(state["near"], pair["before"]), F.lit(CONTEXT_CHARS))
        named = F.lower(near).rlike(kind.context)
        if not kind.base:
            behind = F.substring(pair["match"], F.length(match) + 1, F.lit(CONTEXT_CHARS))
            named = named | F.lower(behind).rlike(kind.context)
        score = F.lit(kind.score) + F.when(named, CONTEXT_SCORE).otherwise(0)
        span = F.struct(F.lit(kind.name).alias("kind"), start.alias("start"), end.alias("end"), score.alias("score"))
        accepted = _valid(kind.name, match)
        if not kind.base:
            accepted = accepted & (score >= THRESHOLD)
        return F.struct(
            (start + F.length(head(pair))).alias("pos"),
            F.right(F.concat(near, head(pair)), F.lit(CONTEXT_CHARS)).alias("near"),
            F.when(accepted, F.concat(state["found"], F.array(span))).otherwise(state["found"]).alias("found"),
        )

    def in_block(part: Column, start: Column) -> Column:
        from_ = F.greatest(start - CONTEXT_CHARS, F.lit(0))
        near = F.substring(text, from_ + 1, start - from_)
        state = F.struct(start.alias("pos"), near.alias("near"), none.alias("found"))
        return F.aggregate(part, state, take, lambda state: state["found"])

    def length(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda n, pair: n + F.length(pair["before"]) + F.length(head(pair)))

    def located(found: Column) -> Column:
        before = F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(found))
        pairs = F.arrays_zip(before.alias("before"), found.alias("match"))
        return F.flatten(_by_blocks(pairs, length, lambda a, b: a + b, in_block))

    return _bound(matches, lambda found: F.when(F.size(found) > 0, located(found)).otherwise(none))


def spans(text: Column) -> Column:
    """All spans of a text that is not NULL: by kind, then by start."""
    return F.concat(*[_spans_of(kind, text) for kind in KINDS])


def joined(found: Column) -> Column:
    return F.array_join(
        F.transform(
            found,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and ``found``, its array of spans."""
    text = F.coalesce("text", F.lit(""))
    return has_columns(docs, "doc_id", "text").select("doc_id", text.alias("text")).select(
        "doc_id", spans(F.col("text")).alias("found")
    )


def redacted(text: Column, found: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by its kind."""
    in_order = F.array_sort(
        F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )

    def in_block(part: Column, start: Column) -> Column:
        # the block's own stretch of text, so that places in it are found fast
        return _bound(F.substring(text, start + 1, last_end(part) - start), lambda own: put_all(part, start, own))

    def put_all(part: Column, start: Column, own: Column) -> Column:
        def put(state: Column, s: Column) -> Column:
            between = F.substring(own, state["pos"] - start + 1, s["start"] - state["pos"])
            mark = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
            return F.struct(
                F.greatest(state["pos"], s["end"]).alias("pos"),
                F.when(s["start"] >= state["pos"], F.concat(state["out"], between, mark))
                .otherwise(state["out"])
                .alias("out"),
            )

        state = F.struct(start.alias("pos"), F.lit("").alias("out"))
        return F.aggregate(part, state, put, lambda state: state["out"])

    def last_end(part: Column) -> Column:
        return F.array_max(F.transform(part, lambda s: s["end"]))

    pieces = _by_blocks(in_order, last_end, lambda a, b: F.greatest(a, b), in_block)
    rest = F.substring(text, F.array_max(F.transform(found, lambda s: s["end"])) + 1, F.length(text))
    return F.concat(F.array_join(pieces, ""), rest)


def redact(docs: DataFrame) -> DataFrame:
    """The documents, personal data replaced, ``n_chars`` counted again; same columns."""
    held = free_name(docs, "__found")
    changed = docs.withColumn(held, F.when(F.col("text").isNotNull(), spans(F.col("text"))))
    text = F.when(F.size(held) > 0, redacted(F.col("text"), F.col(held))).otherwise(F.col("text"))
    replaced = changed.withColumn("text", text)
    if "n_chars" in docs.columns:
        replaced = replaced.withColumn(
            "n_chars", F.when(F.size(held) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
        )
    return replaced.drop(held)


def digests(found: DataFrame) -> DataFrame:
    """Counts and joined spans per document."""
    base = [kind.name for kind in KINDS if kind.base]

    def count(name: str) -> Column:
        return F.size(F.filter("found", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")

    counts = [count(name) for name in base]
    of_base = F.filter("found", lambda s: s["kind"].isin(*base))
    scores = F.array_join(F.transform("found", lambda s: s["score"].cast("string")), ",")
    return found.select(
        "doc_id",
        *counts,
        F.sha2(joined(of_base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        scores.alias("scores"),
    )
