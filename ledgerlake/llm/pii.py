"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust a score.

Only SQL functions are used.  Spark's functions return matches without their places; the text between matches
is had by splitting at the same expression, and the places are sums of the lengths of both.  Long match lists
are summed in blocks of blocks, by element and never by slice (a slice copies its whole array), and only the places of
matches that pass their check are worked out, so the work of finding spans is near linear in the matches.

The expressions are written so that their time is linear in the text: loops do not backtrack, and a match may
begin only where its run of characters begins (or where the last match ended), which changes no match.

Base kinds (email, ip, card, phone) stay whatever their score, once their own check passes.  The other kinds
need a score of ``LEAST_SCORE``: ``iban`` must pass mod 97, ``ssn`` and ``tel`` need a context word before them.
Within a kind spans never overlap; spans of different kinds may.

NULL and empty texts have no spans; rows are independent, so repeated rows, NULL ids and ties change nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import documents, whole_text

LEAST_SCORE = 0.6
CONTEXT_CHARS = 40
CONTEXT_GAIN = 0.3
_BLOCK_BITS = 5
_CHUNK_BITS = 9
_SPANS = "array<struct<kind: string, start: int, end: int, score: double>>"

_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, doubled).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add) % 10 == 0


def mod97(iban: Column) -> Column:
    """Whether an account number passes the mod 97 check, letters counting from 10."""
    text = F.regexp_replace(iban, " ", "")
    moved = F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4))
    chars = F.filter(F.split(moved, ""), lambda c: c != "")

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(chars, F.lit(0), step) == 1


def _card(value: Column) -> Column:
    digits = _digits(value)
    return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(F.lit(False))


@dataclass(frozen=True)
class Kind:
    """``score`` holds once ``confirm`` passes; ``context`` words before a span add ``CONTEXT_GAIN``."""

    name: str
    pattern: str
    confirm: Callable[[Column], Column]
    score: float
    context: str
    base: bool = False


KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda v: F.lit(True), 0.7, "mail|contact|kontakt|correo|courriel", True,
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
        lambda v: v.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), 0.6, "ip|host|server|addr", True,
    ),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", _card, 0.7, "card|visa|karte|tarjeta|carte", True),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda v: F.length(_digits(v)).between(9, 15), 0.6, "tel|phone|call|mobil|fax", True,
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        mod97, 0.8, "iban|account|konto|cuenta|compte",
    ),
    Kind(
        "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda v: ~v.rlike("^(?:000|666|9)|-00-|-0000$"), 0.4, "ssn|social|security",
    ),
    Kind(
        "tel", r"(?<![0-9)+.-])\(?[0-9]{3}\)?[\x20-][0-9]{3}-[0-9]{4}(?![0-9-])",
        lambda v: F.lit(True), 0.4, "tel|phone|call|mobil|fax",
    ),
)


Add = Callable[[Column, Column], Column]


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _total(numbers: Column, first: Column, count: Column, add: Add) -> Column:
    """``count`` numbers of an array from position ``first``, counted from 0, put together from 0 on."""
    places = F.sequence(first, first + count - 1)
    return F.when(count > 0, F.aggregate(places, F.lit(0), lambda a, i: add(a, numbers[i]))).otherwise(F.lit(0))


def _blocks(numbers: Column) -> Column:
    """The numbers of the blocks of an array that is not empty."""
    return F.sequence(F.lit(0), F.shiftright(F.size(numbers) - 1, _BLOCK_BITS))


def _by_block(numbers: Column, add: Add) -> Column:
    size = 1 << _BLOCK_BITS
    return F.transform(_blocks(numbers), lambda b: _total(numbers, b * size, F.least(F.lit(size), F.size(numbers) - b * size), add))


def _before(numbers: Column, blocks: Column, i: Column, add: Add) -> Column:
    """The total of the numbers before position ``i``, where ``blocks`` holds the total before each block."""
    within = i.bitwiseAND((1 << _BLOCK_BITS) - 1)
    return add(blocks[F.shiftright(i, _BLOCK_BITS)], _total(numbers, i - within, within, add))


def _there(prefix: str, name: str) -> Column:
    # Also a second use of the column: one that is used once, inside a lambda, is moved into it by the optimizer
    # and worked out again for every element.
    return F.size(f"_{prefix}_{name}") > 0


def _step(frame: DataFrame, some: dict[str, Column], prefix: str, of: str, made: Callable[[str], Column]) -> DataFrame:
    """Adds a column per name, where there is something, made of the column with prefix ``of``."""
    return frame.withColumns({f"_{prefix}_{n}": F.when(x & _there(of, n), made(n)) for n, x in some.items()})


def _with_totals(frame: DataFrame, some: dict[str, Column], add: Add) -> DataFrame:
    """Adds ``b``, the totals before each block of the numbers in ``l``.

    s and t are the totals of their blocks and of the blocks of those, u the totals before each of the latter.
    """

    def col(prefix: str, name: str) -> Column:
        return F.col(f"_{prefix}_{name}")

    made = _step(frame, some, "s", "l", lambda n: _by_block(col("l", n), add))
    made = _step(made, some, "t", "s", lambda n: _by_block(col("s", n), add))
    made = _step(made, some, "u", "t", lambda n: F.transform(_blocks(col("s", n)), lambda b: _total(col("t", n), F.lit(0), b, add)))
    return _step(
        made, some, "b", "u", lambda n: F.transform(_blocks(col("l", n)), lambda b: _before(col("s", n), col("u", n), b, add))
    )


def _with_spans(rows: DataFrame, text: str, kinds: tuple[Kind, ...]) -> DataFrame:
    """Adds ``_spans``, every confirmed span in the order of the kinds and of the places.

    Intermediate columns are built step by step, so that each expression is evaluated once per text.
    """
    names = rows.columns
    k = [x.name for x in kinds]
    found = rows.withColumns({f"_m_{x.name}": F.regexp_extract_all(text, F.lit(x.pattern), F.lit(0)) for x in kinds})
    gaps = found.withColumns(
        {f"_g_{x.name}": F.when(F.size(f"_m_{x.name}") > 0, F.split(F.col(text), x.pattern)) for x in kinds}
    )
    some = {n: F.size(f"_m_{n}") > 0 for n in k}

    def passed(kind: Kind) -> Column:
        matches = F.col(f"_m_{kind.name}")
        return F.filter(F.sequence(F.lit(0), F.size(matches) - 1), lambda i: kind.confirm(matches[i]))

    # o: which matches pass their check; l: lengths of gap and match together.
    by_name = {x.name: x for x in kinds}
    checked = _step(gaps, some, "o", "m", lambda n: passed(by_name[n]))
    some = {n: F.size(f"_o_{n}") > 0 for n in k}
    lengths = _step(
        checked, some, "l", "g", lambda n: F.transform(f"_m_{n}", lambda m, i: F.length(F.col(f"_g_{n}")[i]) + F.length(m))
    )
    before = _with_totals(lengths, some, _sum)

    def span(kind: Kind) -> Column:
        n = kind.name
        matches, gap, length, base = (F.col(f"_{p}_{n}") for p in "mglb")

        def one(i: Column) -> Column:
            start = _before(length, base, i, _sum) + F.length(gap[i])
            context = F.right(gap[i], F.lit(CONTEXT_CHARS)).rlike(f"(?i)(?:{kind.context})")
            score = F.lit(kind.score) + F.when(context, CONTEXT_GAIN).otherwise(0.0)
            return F.struct(
                F.lit(n).alias("kind"), start.alias("start"), (start + F.length(matches[i])).alias("end"), score.alias("score")
            )

        found = F.transform(f"_o_{n}", one)
        own = found if kind.base else F.filter(found, lambda s: s["score"] >= LEAST_SCORE)
        return F.coalesce(F.when(some[n] & _there("b", n), own), F.array().cast(_SPANS))

    return before.select(*names, F.concat(*[span(x) for x in kinds]).alias("_spans"))


def spans(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``doc_id, spans``: an array of kind, start, end (code points, end exclusive) and score per document."""
    return _with_spans(documents(docs), "text", kinds).select("doc_id", F.col("_spans").alias("spans"))


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """Counts of the base kinds per document, the digest of their spans, and all spans as text."""
    base = [k.name for k in KINDS if k.base]
    own = F.filter("spans", lambda s: s["kind"].isin(base))

    def of_kind(name: str) -> Column:
        return F.filter("spans", lambda s: s["kind"] == name)

    counts = [F.size(of_kind(n)).cast("long").alias(f"n_{n}") for n in base]
    return found.select("doc_id", *counts, F.sha2(_listed(own), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets; overlapping spans become one.

    Other columns stay, but ``n_chars``, where there is one, follows the new text.
    """
    columns = docs.columns
    found = _with_spans(docs.withColumn("_text", whole_text()), "_text", kinds)
    some = F.size("_spans") > 0
    ordered = F.array_sort(F.transform("_spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    # A text is cut into chunks, as a substring is found by counting characters from the start.
    chunks = F.regexp_extract_all("_text", F.lit(f"(?s).{{1,{1 << _CHUNK_BITS}}}+"), F.lit(0))
    sorted_ = found.withColumns({"_o_all": F.when(some, ordered), "_c_all": F.when(some, chunks)})
    ends = _step(sorted_, {"all": some}, "l", "o", lambda _: F.transform("_o_all", lambda s: s["end"]))
    # The greatest end of the spans before a span: it starts a label unless it begins before that.
    covered = _with_totals(ends, {"all": some}, F.greatest)

    def labelled(s: Column, i: Column) -> Column:
        at = _before(F.col("_l_all"), F.col("_b_all"), i, F.greatest)
        return F.when(s["start"] >= at, F.concat(_between(F.col("_c_all"), at, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise("")

    rest = _between(F.col("_c_all"), F.array_max("_l_all"), F.length("_text"))
    used = some & _there("b", "all") & _there("c", "all") & _there("l", "all")
    new = F.when(used, F.concat(F.array_join(F.transform("_o_all", labelled), ""), rest)).otherwise(F.col("text"))
    replaced = covered.withColumn("text", new)
    if "n_chars" in columns:
        replaced = replaced.withColumn("n_chars", F.when(some, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return replaced.select(*columns)


def _between(chunks: Column, start: Column, end: Column) -> Column:
    """The characters from ``start`` to before ``end`` of a text that is cut into chunks."""
    size = 1 << _CHUNK_BITS
    first, last = F.shiftright(start, _CHUNK_BITS), F.shiftright(end, _CHUNK_BITS)
    at, upto = start.bitwiseAND(size - 1), end.bitwiseAND(size - 1)
    whole = F.when(last > first + 1, F.array_join(F.transform(F.sequence(first + 1, last - 1), lambda j: chunks[j]), "")).otherwise("")

    def part(number: Column, begin: Column, count: Column) -> Column:
        # The chunk after the last one is empty.
        return F.substring(F.coalesce(F.get(chunks, number), F.lit("")), begin, count)

    across = F.concat(part(first, at + 1, F.lit(size)), whole, part(last, F.lit(1), upto))
    return F.when(first == last, part(first, at + 1, upto - at)).otherwise(across)
