"""Personal data by DataFrame functions: regular expressions propose spans, checksums confirm them, and words near a span
adjust its score.

A pattern's matches and what stands between them come from ``regexp_extract_all`` and ``split``; the running sum of their
lengths gives the offsets (code points, end exclusive). Kinds: e-mail, IP address, payment card (14 to 19 digits, Luhn),
phone number (10 to 15 digits), and the added IBAN (mod 97) and social security number. An IBAN ends at its country's
length, so that a word or number after it is not taken in; after an unknown country code any length is tried. Matches of
one kind do not overlap, and one that fails its check is dropped. A span's score is its kind's, plus or minus what the context words
within ``NEAR`` characters say. Spans of the four base kinds stay whatever their score; of the added ones only those that
reach ``LEAST``. A social security number has no checksum and needs a context word.

The patterns are possessive and start at the beginning of a run of characters, so that Java neither recurses nor tries a
long run from each of its characters; running sums work in two levels, so that the work grows with the text. All is done
row by row, without a shuffle and without Python.

Defined results: a null text has no spans and stays null when masked; an empty text has none; spans of different kinds
may overlap, and masking then replaces their union once; repeated rows are each searched; an empty table gives an empty
table; extra columns are kept by ``mask`` and not read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.llm.common import table

#: Characters before and after a span in which context words count.
NEAR = 40
#: Least score of a span of the added kinds.
LEAST = 0.5
#: Score that a context word adds or takes.
STEP = 0.3
#: Elements of one run of a running sum; characters of one block of a text that is masked.
_RUN, _BLOCK = 256, 4096


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _length_between(value: Column, low: int, high: int) -> Column:
    return F.length(value).between(low, high)


def _mod_97(value: Column) -> Column:
    """The IBAN check: the first four characters go to the end, letters count as 10 to 35, the rest by 97 is 1."""
    compact = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(compact, 5, 40), F.substring(compact, 1, 4))
    chars = F.filter(F.split(turned, ""), lambda c: c != "")
    rest = F.aggregate(chars, F.lit(0), lambda a, c: F.when(
        c <= "9", (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))
    return _length_between(compact, 15, 34) & (rest == 1)


#: Characters of an IBAN and the countries with that length.
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "AO CV GW LY MZ PT ST", 26: "DZ IR IS TR", 27: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    28: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}


def _iban(blank: str) -> str:
    """IBANs of known countries; ``blank`` stands between groups of four."""
    def of(length: int, codes: str) -> str:
        fours, rest = divmod(length - 4, 4)
        return (f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?:{blank}[A-Z0-9]{{4}}){{{fours}}}"
                + (f"{blank}[A-Z0-9]{{{rest}}}" if rest else ""))
    return f"(?:{'|'.join(of(*x) for x in IBAN_COUNTRIES.items())})(?![A-Za-z0-9])"


# a blank within an IBAN: no other IBAN starts after it
_BLANK = rf"(?:\x20(?!{_iban(chr(92) + 'x20?')}))?"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    check: Callable[[Column], Column]
    score: float
    hint: str  # characters that every match has: texts without them are not searched
    for_it: str  # words that speak for it
    against: str  # words that speak against it


# The base patterns are equal to  [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ ,
# [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+) , [0-9]([\x20-]?[0-9])+  and  \+[0-9][\x20().0-9-]+[0-9]
BASE = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         lambda v: F.lit(True), 0.8, "@", "e-?mail|mail|contact|kontakt|courriel|correo|write|from|to", "example|noreply"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         lambda v: v.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"), 0.6, ".", "ip|host|server|address|adresse|login",
         "version|release|section"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++",
         lambda v: _length_between(_digits(v), 14, 19) & F.call_function("luhn_check", _digits(v)), 0.7, "",
         "card|visa|credit|debit|karte|carte|tarjeta|payment", "isbn|order|tracking|serial"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: _length_between(_digits(v), 10, 15), 0.6, "+",
         "tel|phone|call|mobile|fax|telefon|téléphone|teléfono", "order|tracking|serial"),
)
ADDED = (
    Kind("iban", rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:{_iban(_BLANK)}"
         rf"|[A-Z]{{2}}[0-9]{{2}}(?:{_BLANK}[A-Z0-9]{{4}}){{2,7}}(?:{_BLANK}[A-Z0-9]{{1,3}})?(?![A-Za-z0-9]))",
         _mod_97, 0.8, "", "iban|account|bank|konto|compte|cuenta", "serial|part"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
         lambda v: ~v.rlike("^(?:000|666|9)|-00-|-0000$"), 0.3, "-", "ssn|social security|sozialversicherung", "order|part"),
)
KINDS = (*BASE, *ADDED)
_SPAN = "array<struct<start:int,no:int,end:int,score:double>>"


def _before(df: DataFrame, name: str, values: str, both: Callable[[Column, Column], Column]) -> DataFrame:
    """Adds column ``name``: for each element of array<int> column ``values`` what ``both`` makes of 0 and all elements
    before it. Two levels: runs of _RUN elements, and the runs' results."""
    empty = F.array().cast("array<int>")

    def each(array: Column, start: Column) -> Column:
        return F.aggregate(array, F.struct(start.alias("now"), empty.alias("out")), lambda a, x: F.struct(
            both(a["now"], x).alias("now"), F.concat(a["out"], F.array(a["now"])).alias("out")))["out"]

    runs, of_run = f"{name}_runs", f"{name}_of_run"
    df = df.withColumn(runs, F.when(F.size(values) > 0, F.sequence(
        F.lit(0), F.floor((F.size(values) - 1) / _RUN).cast("int"))).otherwise(empty))
    piece = lambda k: F.slice(values, k * _RUN + 1, F.lit(_RUN))
    df = df.withColumn(of_run, each(F.transform(runs, lambda k: F.aggregate(piece(k), F.lit(0), both)), F.lit(0)))
    return df.withColumn(name, F.flatten(F.transform(runs, lambda k: each(piece(k), F.get(of_run, k))))).drop(runs, of_run)


def _near(words: str) -> str:
    return rf"(?iu)\b(?:{words})\b"


def _with_kind(df: DataFrame, text: str, no: int, kind: Kind) -> DataFrame:
    """Adds the sorted spans of one kind as array column ``__pii_<name>``."""
    parts, found, sizes, at, out = (f"__pii_{x}" for x in ("parts", "found", "sizes", "at", kind.name))
    worth = F.col(text).isNotNull() & (F.contains(F.col(text), F.lit(kind.hint)) if kind.hint else F.lit(True))
    df = df.withColumn(found, F.when(worth, F.regexp_extract_all(F.col(text), F.lit(kind.pattern), F.lit(0))))
    df = df.withColumn(found, F.coalesce(found, F.array().cast("array<string>")))
    df = df.withColumn(parts, F.when(F.size(found) > 0, F.split(F.col(text), kind.pattern)))
    df = df.withColumn(sizes, F.transform(found, lambda v, i: F.length(F.get(parts, i)) + F.length(v)))
    df = _before(df, at, sizes, lambda a, b: a + b)

    def span(value: Column, i: Column) -> Column:
        start = F.get(at, i) + F.length(F.get(parts, i))
        near = F.concat(F.right(F.get(parts, i), F.lit(NEAR)), F.lit(" "), F.left(F.get(parts, i + 1), F.lit(NEAR)))
        score = F.lit(kind.score) + F.when(near.rlike(_near(kind.for_it)), STEP).otherwise(0.0) - F.when(
            near.rlike(_near(kind.against)), STEP).otherwise(0.0)
        return F.when(kind.check(value), F.struct(start.alias("start"), F.lit(no).alias("no"), (start + F.length(value)).alias(
            "end"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)).alias("score")))

    spans = F.filter(F.transform(found, span), lambda s: s.isNotNull() & (
        F.lit(True) if no < len(BASE) else s["score"] >= LEAST))
    return df.withColumn(out, spans.cast(_SPAN)).drop(parts, found, sizes, at)


def _with_spans(df: DataFrame, text: str) -> DataFrame:
    """Adds ``__pii_<name>`` of every kind and ``__pii_all``, the spans of all by start and kind."""
    for no, kind in enumerate(KINDS):
        df = _with_kind(df, text, no, kind)
    return df.withColumn("__pii_all", F.array_sort(F.concat(*(F.col(f"__pii_{k.name}") for k in KINDS))))


def _name(no: Column) -> Column:
    return F.get(F.array(*(F.lit(k.name) for k in KINDS)), no)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end, score>>) of every row, by start and then kind."""
    picked = _with_spans(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), "text")
    spans = F.transform("__pii_all", lambda s: F.struct(_name(s["no"]).alias("kind"), s["start"].alias("start"),
                                                        s["end"].alias("end"), s["score"].alias("score")))
    return picked.select(F.col("id").alias(id_col), spans.alias("spans"))


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span of the text replaced by its kind, as in ``<EMAIL>``; spans that overlap are replaced
    together, by the kind of the first. All rows and columns stay."""
    names = docs.columns
    df = _with_spans(docs.withColumn("__pii_text", F.col(text_col).cast("string")), "__pii_text")
    df = df.withColumn("__pii_ends", F.transform("__pii_all", lambda s: s["end"]))
    df = _before(df, "__pii_done", "__pii_ends", lambda a, b: F.greatest(a, b))
    df = df.withColumn("__pii_blocks", F.when(F.size("__pii_all") > 0, F.regexp_extract_all(
        "__pii_text", F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))))
    blocks = F.col("__pii_blocks")

    def cut(start: Column, end: Column) -> Column:
        """Characters start to end of the text."""
        first, last = (F.floor(x / _BLOCK).cast("int") for x in (start, end))
        head, tail = F.get(blocks, first), F.get(blocks, last)
        within = F.substring(head, start % _BLOCK + 1, end - start)
        over = F.concat(F.substring(head, start % _BLOCK + 1, F.lit(_BLOCK)), F.array_join(F.slice(
            blocks, first + 2, F.greatest(last - first - 1, F.lit(0))), ""), F.coalesce(
            F.substring(tail, F.lit(1), end % _BLOCK), F.lit("")))
        return F.when(start >= end, "").when(first == last, within).otherwise(over)

    pieces = F.transform("__pii_all", lambda s, i: F.when(s["start"] >= F.get("__pii_done", i), F.concat(
        cut(F.get("__pii_done", i), s["start"]), F.lit("<"), F.upper(_name(s["no"])), F.lit(">"))).otherwise(""))
    rest = cut(F.array_max("__pii_ends"), F.length("__pii_text"))
    masked = F.when(F.size("__pii_all") > 0, F.concat(F.array_join(pieces, ""), rest)).otherwise(F.col("__pii_text"))
    return df.withColumn(text_col, masked).select(*names)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents"))
    of = lambda name: F.filter("spans", lambda s: s["kind"] == name)
    base = F.filter("spans", lambda s: s["kind"].isin([k.name for k in BASE]))
    return found.select("doc_id", *(F.size(of(k.name)).cast("long").alias(f"n_{k.name}") for k in BASE),
                        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
                        F.transform("spans", lambda s: s["score"]).alias("scores"))
