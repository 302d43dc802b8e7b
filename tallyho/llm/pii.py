"""Personal data: patterns propose spans, checksums confirm them, words nearby move the score.

Everything is a Column expression over one row: no shuffle, no Python.  The places of a
pattern's matches come from the texts between them (``split``) and the matches themselves
(``regexp_extract_all``), whose lengths add up to offsets.  The patterns here find what the
plain ones in ``KINDS``' comments find, in time linear in the text: a run of characters that
can start a match is tried at its first character only (or where the last match ended), and
what was taken is not given back where giving back cannot help.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUM_BLOCK = 256   # lengths added up at once; keeps offsets of very many matches near linear


@dataclass(frozen=True)
class Kind:
    """``pattern`` proposes, ``check`` confirms; ``needs``: a text without this has no match.

    The score is ``prior``, plus ``checked`` if a checksum holds, plus ``near`` if a word of
    ``context`` and minus ``near`` if a word of ``against`` stands within the window.
    A base kind is reported whatever its score, another one from the threshold on.
    """

    name: str
    pattern: str
    check: object = None
    base: bool = False
    needs: str = ""
    prior: float = 0.5
    checked: float = 0.0
    near: float = 0.2
    context: str = ""
    against: str = ""


@dataclass(frozen=True)
class Params:
    """``window`` characters on each side, up to the next candidate of the kind, are the context."""

    window: int = 40
    threshold: float = 0.6
    version: str = "pii-1"


def let(value: Column, fn) -> Column:
    """``fn(value)`` with the value computed once, however often ``fn`` or a lambda within it uses it."""
    return F.get(F.transform(F.array(value), lambda v: fn(v)), 0)


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _code(text: Column, at: Column) -> Column:
    return F.ascii(F.substring(text, at, F.lit(1)))


def luhn(digits: Column) -> Column:
    """Whether the digits' Luhn sum is a multiple of 10."""
    def total(back):
        def add(so_far, i):
            d = _code(back, i) - 48
            twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
            return so_far + F.when(i % 2 == 0, twice).otherwise(d)
        return F.aggregate(F.sequence(F.lit(1), F.length(back)), F.lit(0), add)
    return let(F.reverse(digits), total) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether the code, its first four characters moved to its end and letters read as 10 to 35, is 1 modulo 97."""
    def rest(turned):
        def add(so_far, i):
            c = _code(turned, i)
            return F.when(c < 58, (so_far * 10 + c - 48) % 97).otherwise((so_far * 100 + c - 55) % 97)
        return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), add)
    return let(F.concat(F.substring(code, 5, 99), F.substring(code, 1, 4)), rest) == 1


def _ip(match, before, after):
    """Every part at most 255, however many zeros lead it."""
    return ~F.exists(F.split(match, r"\."), lambda x: (F.length(F.ltrim(x, F.lit("0"))) > 3)
                     | (F.substring(x, -3, 3).try_cast("int") > 255))


def _card(match, before, after):
    return let(_digits(match), lambda d: F.length(d).between(12, 19) & luhn(F.substring(d, 1, 19)))


def _phone(match, before, after):
    return F.length(_digits(match)).between(9, 15)


def _alone(before, after, more: str = ""):
    """Neither side goes on with a letter, a digit or one of ``more``."""
    part = f"[A-Za-z0-9{more}]"
    return ~(F.right(before, F.lit(1)).rlike(part) | F.left(after, F.lit(1)).rlike(part))


def _iban(match, before, after):
    whole = let(F.replace(match, F.lit(" "), F.lit("")), lambda code: F.length(code).between(15, 34) & mod97(code))
    return _alone(before, after) & whole


def _ssn(match, before, after):
    return _alone(before, after, "-") & ~match.rlike("^(000|666|9)|-00-|-0000$")


def _tel(match, before, after):
    return _alone(before, after, "+-") & ~before.rlike(r"\+[0-9]{1,3} ?$")


# Fixed: names, order and sets of base kinds.  The plain patterns, each leftmost and without retries:
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+     ip [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+), parts at most 255
#   card  [0-9]([\x20-]?[0-9])+, 12 to 19 digits that pass Luhn  phone \+[0-9][\x20().0-9-]+[0-9], 9 to 15 digits
KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", None, True, "@",
         0.9, context="mail|contact|write|correo|kontakt"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _ip, True, ".", 0.6, context="ip|address|host|server|login|from",
         against="version|release|v"),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", _card, True, "", 0.4, 0.3, context="card|visa|mastercard|credit|payment|karte|tarjeta|carte",
         against="isbn|order|serial"),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", _phone, True, "+", 0.7, context="phone|tel|call|mobile|fax|telefon|llame"),
    Kind("iban", r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?", _iban, False, "", 0.3, 0.4,
         context="iban|account|bank|konto|cuenta|compte"),
    Kind("ssn", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", _ssn, False, "-", 0.4, 0.0, 0.3, context="ssn|social|security|taxpayer"),
    Kind("tel", r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}", _tel, False, "", 0.4, 0.0, 0.3,
         context="phone|tel|call|mobile|fax|telefon|llame", against="isbn|order|serial"))


def _running(lengths: Column) -> Column:
    """Sums of ``lengths`` up to and with each, in blocks, so that arrays that grow stay short."""
    def sums(values):
        grown = F.aggregate(values, F.struct(F.lit(0).cast("long").alias("s"), F.array().cast("array<bigint>").alias("a")),
                            lambda acc, x: F.struct((acc.s + x).alias("s"), F.array_append(acc.a, acc.s + x).alias("a")))
        return grown["a"]

    def joined(blocks):
        ends = sums(F.transform(blocks, lambda b: F.element_at(b, -1)))
        return let(ends, lambda e: F.flatten(F.transform(blocks, lambda b, i: let(
            F.when(i > 0, F.get(e, i - 1)).otherwise(F.lit(0).cast("long")), lambda base: F.transform(b, lambda x: x + base)))))

    def blocked(values):
        starts = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / SUM_BLOCK).cast("int"))
        return let(F.transform(starts, lambda b: sums(F.slice(values, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK)))), joined)
    return let(lengths, lambda v: F.when(F.size(v) > 0, blocked(v)).otherwise(F.array().cast("array<bigint>")))


def _pieces(text: Column, kind: Kind) -> tuple[Column, Column]:
    """Matches of the pattern and the texts around them, one more than matches."""
    found, around = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), F.split(text, kind.pattern, -1)
    if not kind.needs:
        return found, around
    can = F.contains(text, F.lit(kind.needs))
    return F.when(can, found).otherwise(F.array().cast("array<string>")), F.when(can, around).otherwise(F.array(text))


def _word(words: str) -> str:
    return rf"(^|[^a-z])({words})([^a-z]|$)"


def _valid(kind: Kind, match: Column, before: Column, after: Column) -> Column:
    return kind.check(match, before, after) if kind.check else F.lit(True)


def _score(kind: Kind, before: Column, after: Column, p: Params) -> Column:
    near = F.lower(F.concat(F.right(before, F.lit(p.window)), F.lit(" "), F.left(after, F.lit(p.window))))
    score = F.lit(kind.prior + kind.checked) + F.when(near.rlike(_word(kind.context)), kind.near).otherwise(0.0)
    if kind.against:
        score = score - F.when(near.rlike(_word(kind.against)), kind.near).otherwise(0.0)
    return F.round(F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0)), 3)


def spans_of(matches: Column, around: Column, kind: Kind, nth: int, p: Params = Params()) -> Column:
    """Spans of one kind: array of (start, nth, end, kind, value, score), ends exclusive, in code points."""
    n = F.size(matches)
    lengths = F.flatten(F.zip_with(F.slice(around, F.lit(1), n), matches, lambda a, m: F.array(F.length(a), F.length(m)))).cast("array<bigint>")
    rows = let(_running(lengths), lambda ends: F.transform(matches, lambda m, i: F.struct(
        F.get(ends, i * 2).alias("start"), F.lit(nth).alias("nth"), F.get(ends, i * 2 + 1).alias("end"), F.lit(kind.name).alias("kind"),
        m.alias("value"), F.get(around, i).alias("before"), F.get(around, i + 1).alias("after"))))
    kept = F.filter(rows, lambda r: _valid(kind, r["value"], r["before"], r["after"]))
    scored = F.transform(kept, lambda r: F.struct(r["start"].alias("start"), r["nth"].alias("nth"), r["end"].alias("end"),
                                                  r["kind"].alias("kind"), r["value"].alias("value"),
                                                  _score(kind, r["before"], r["after"], p).alias("score")))
    return scored if kind.base else F.filter(scored, lambda r: r["score"] >= p.threshold)


def find(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``doc_id, spans`` for every row: all kinds' spans, ordered by start and kind.

    Null and empty texts have none.  Spans of different kinds may overlap.  A base kind's span is
    always reported, of the other kinds those whose score reaches the threshold.  Rows that
    repeat an id, and rows without one, are rows of their own.  Other columns are not read; an
    empty table gives an empty result.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cut = rows.select("doc_id", *[c.alias(f"{side}{i}") for i, k in enumerate(KINDS) for side, c in zip("mp", _pieces(F.col("text"), k))])
    each = [spans_of(F.col(f"m{i}"), F.col(f"p{i}"), k, i, p) for i, k in enumerate(KINDS)]
    return cut.select("doc_id", F.sort_array(F.concat(*each)).alias("spans"))


def findings(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``doc_id, kind, start, end, value, score``: one row a span of ``find``."""
    return (find(docs, p).select("doc_id", F.explode("spans").alias("s"))
            .select("doc_id", "s.kind", "s.start", "s.end", "s.value", "s.score"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digests(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Per document: counts of the base kinds, a digest of their spans, and all spans, as text."""
    rows = find(docs, p)
    base = F.filter("spans", lambda s: s["nth"] < sum(k.base for k in KINDS))

    def count(name):
        return F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long").alias(f"n_{name}")
    counts = [count(k.name) for k in KINDS if k.base]
    return rows.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def _marker(kind: Kind, around: Column, p: Params):
    def mark(match, i):
        before, after = F.get(around, i), F.get(around, i + 1)
        hit = _valid(kind, match, before, after)
        if not kind.base:
            hit = hit & (_score(kind, before, after, p) >= p.threshold)
        return F.concat(before, F.when(hit, F.lit(f"[{kind.name.upper()}]")).otherwise(match))
    return mark


def redacted(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs``, all columns, with each span in the text replaced by its kind, as ``[EMAIL]``.

    Kinds are replaced one after another in ``KINDS``' order, each in the text the one before
    left, so overlapping spans become one mark.  Null texts stay null.
    """
    rows = docs.select(F.struct("*").alias("_row")).select("_row", F.col("_row.text").cast("string").alias("_text"))
    for k in KINDS:
        cut = rows.select("_row", "_text", *[c.alias(n) for n, c in zip(("_m", "_p"), _pieces(F.col("_text"), k))])
        joined = F.concat(F.array_join(F.transform("_m", _marker(k, F.col("_p"), p)), ""), F.element_at("_p", -1))
        rows = cut.select("_row", F.when(F.size("_m") > 0, joined).otherwise(F.col("_text")).alias("_text"))
    return rows.select(*[(F.col("_text") if c == "text" else F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
