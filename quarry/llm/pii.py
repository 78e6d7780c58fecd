"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Everything is a DataFrame expression. Offsets are code points, ends exclusive. Patterns are written so
that a long run of one character class costs linear time: possessive repeats, and a match may begin
inside a run only where the previous match ended. Offsets of many matches are summed up in runs of RUN_SIZE, and
context words are looked for in a page of the text, so that neither costs the number of matches times the length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.tables import whole

# Kinds in the order of the report, base kinds first.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "secret")
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])"
# Credentials whose issuers publish their form, and any other run of at least 16 with a digit and a letter.
ISSUED = (
    r"(?<![A-Za-z0-9_])(?:(?:AKIA|ASIA)[0-9A-Z]{16}+(?![A-Za-z0-9_])|gh[pousr]_[A-Za-z0-9]{36,}+|xox[abprs]-[A-Za-z0-9-]{10,}+"
    r"|AIza[A-Za-z0-9_-]{35}+|eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+|-----BEGIN[A-Z\x20]{0,24}PRIVATE\x20KEY-----)"
)
RUN = r"(?<![A-Za-z0-9_])(?=[A-Za-z_]*+[0-9])(?=[0-9_]*+[A-Za-z])[A-Za-z0-9_]{16,}+"
SECRET = f"{ISSUED}|{RUN}"
BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
IP_VALID = rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$"
JOINED = ""  # stands for a blank or hyphen between two digits
CARD = f"[0-9{JOINED}]{{16,}}+"
CONTEXT = {
    "email": "mail|contact|write to",
    "ip": r"\bip\b|address|host|server",
    "card": "card|visa|credit|payment|account",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|account|bank|transfer",
    "secret": "token|key|secret|password|credential",
}
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.6, "iban": 0.8, "secret": 0.4}
BONUS, FORM, WINDOW, THRESHOLD = 0.2, 0.3, 32, 0.5

Span = "struct<start:int,stop:int,said:string>"


#: Matches whose offsets are summed up at a time, and characters of a page.
RUN_SIZE = 128
PAGE = 2048


def totals(lengths: Column) -> Column:
    """Sums of all entries before each. An array grows by a copy per entry, so only short ones are made this way."""
    grown = F.aggregate(lengths, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["out"], F.array(a["at"])).alias("out")))
    return grown["out"]


def offsets(lengths: Column) -> Column:
    """totals() of a long array: within runs of RUN_SIZE, then over the runs."""
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.size(lengths), F.lit(1)), F.lit(RUN_SIZE)), lambda i: F.slice(lengths, i, F.lit(RUN_SIZE)))
    inner = F.transform(runs, lambda run: F.struct(totals(run).alias("own"), F.aggregate(run, F.lit(0), lambda a, n: a + n).alias("all")))
    both = lambda x: F.zip_with(x, totals(F.transform(x, lambda r: r["all"])), lambda r, base: F.transform(r["own"], lambda n: n + base))
    return F.flatten(F.element_at(F.transform(F.array(inner), both), 1))  # the runs are made once, not for each mention


def found(text: Column, pattern: str) -> Column:
    """All leftmost, non-overlapping matches with their offsets: gaps and matches alternate, so lengths add up."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)

    def spans(x: Column) -> Column:
        lengths = F.zip_with(F.slice(x["gaps"], F.lit(1), F.size(x["hits"])), x["hits"], lambda gap, hit: gap + F.length(hit))
        starts = F.zip_with(offsets(lengths), F.slice(x["gaps"], F.lit(1), F.size(x["hits"])), lambda at, gap: at + gap)
        return F.zip_with(starts, x["hits"], lambda at, hit: F.struct(at.alias("start"), (at + F.length(hit)).alias("stop"), hit.alias("said")))

    none = F.array().cast(f"array<{Span}>")
    once = lambda x: F.when(F.size(x["hits"]) > 0, spans(x)).otherwise(none)
    return F.element_at(F.transform(F.array(F.struct(hits.alias("hits"), gaps.alias("gaps"))), once), 1)


def pages(text: Column) -> Column:
    """The text in pages of PAGE characters, each with WINDOW characters of its neighbours at both ends; the first lacks those before."""
    first = lambda k: F.greatest(k * PAGE - WINDOW, F.lit(0))
    return F.transform(F.sequence(F.lit(0), F.floor(F.length(text) / PAGE).cast("int")), lambda k: F.substring(text, first(k) + 1, (k + 1) * PAGE + WINDOW - first(k)))


def part(pages_: Column, start: Column, length: Column) -> Column:
    """`length` characters, WINDOW at most, from `start` on, out of the page in which they begin."""
    k = F.floor(start / PAGE).cast("int")
    return F.substring(F.get(pages_, k), start - F.greatest(k * PAGE - WINDOW, F.lit(0)) + 1, length)


def digits(said: Column) -> Column:
    return F.regexp_replace(said, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """True where the digits pass the Luhn sum: every second digit from the right is doubled, its digits added."""
    flipped = F.split(F.reverse(number), "")
    total = F.aggregate(
        F.transform(
            flipped,
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
                F.floor(d.cast("int") * 2 / 10).cast("int") + d.cast("int") * 2 % 10
            ),
        ),
        F.lit(0),
        lambda a, x: a + F.coalesce(x, F.lit(0)),
    )
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """True where the account number, its first four characters moved to the end, leaves 1 modulo 97."""
    plain = F.replace(account, F.lit(" "), F.lit(""))
    turned = F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda a, c: F.when(c == "", a)
        .when(c.between("0", "9"), (a * 10 + F.coalesce(c.try_cast("int"), F.lit(0))) % 97)
        .otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )
    return rest == 1


def confirmed(kind: str, text: Column) -> Column:
    """Spans of one kind whose validator agrees; a text without the kind's telling character is not scanned."""
    none = F.array().cast(f"array<{Span}>")
    if kind == "email":
        return F.when(F.contains(text, F.lit("@")), found(text, EMAIL)).otherwise(none)
    if kind == "ip":
        return F.when(text.rlike(IP), F.filter(found(text, IP), lambda s: s["said"].rlike(IP_VALID))).otherwise(none)
    if kind == "card":
        marked = F.regexp_replace(F.translate(text, JOINED, "?"), r"(?<=[0-9])[\x20-](?=[0-9])", JOINED)
        good = lambda s: F.length(digits(s["said"])).between(16, 19) & luhn(digits(s["said"]))
        return F.when(text.rlike(r"[0-9](?:[\x20-]?[0-9]){15}"), F.filter(found(marked, CARD), good)).otherwise(none)
    if kind == "phone":
        good = lambda s: F.length(digits(s["said"])).between(8, 15)
        return F.when(F.contains(text, F.lit("+")), F.filter(found(text, PHONE), good)).otherwise(none)
    if kind == "iban":
        return F.when(text.rlike(IBAN), F.filter(found(text, IBAN), lambda s: mod97(s["said"]))).otherwise(none)
    return F.when(text.rlike(SECRET), found(text, SECRET)).otherwise(none)


def scored(kind: str, spans: Column, pages_: Column) -> Column:
    """Adds kind and score: the kind's prior, more if a context word stands within WINDOW characters on either side.

    A credential in a published form scores more too; any other run of characters needs a context word.
    """

    def one(s: Column) -> Column:
        reach = F.least(s["start"], F.lit(WINDOW))
        before = part(pages_, s["start"] - reach, reach)
        after = part(pages_, s["stop"], F.lit(WINDOW))
        near = F.lower(F.concat(before, F.lit("\n"), after))
        score = F.lit(PRIOR[kind]) + F.when(near.rlike(CONTEXT[kind]), BONUS).otherwise(0.0)
        if kind == "secret":
            score = score + F.when(s["said"].rlike(f"^(?:{ISSUED})"), FORM).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"), score.alias("score"))

    return F.transform(spans, one)


def pii_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key and `spans`, an array of (kind, start, stop, score).

    Base kinds keep every confirmed span; added kinds need a score of THRESHOLD. A null or empty text has
    no spans, a repeated row gets its result again, an empty table gives none. Other columns are not read,
    so their names cannot clash.
    """
    rows = docs.select(F.col(key).alias("doc_id"), whole(text).alias("body"))
    for kind in BASE_KINDS + ADDED_KINDS:
        rows = rows.withColumn(kind, confirmed(kind, F.col("body")))
    some = F.lit(False)
    for kind in BASE_KINDS + ADDED_KINDS:
        some = some | (F.size(kind) > 0)
    # A generator, so that spans and pages are made once and not for each mention.
    rows = rows.select("doc_id", F.inline(F.array(F.struct(*BASE_KINDS, *ADDED_KINDS, "body")))).withColumn("pages", F.when(some, pages(F.col("body"))))
    each = [scored(k, F.col(k), F.col("pages")) for k in BASE_KINDS]
    each += [F.filter(scored(k, F.col(k), F.col("pages")), lambda s: s["score"] >= THRESHOLD) for k in ADDED_KINDS]
    return rows.select("doc_id", F.concat(*each).alias("spans"))


def listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))))


def digest(docs: DataFrame) -> DataFrame:
    """The report per document: counts of base kinds, a digest of the base spans, all spans, and whether there are any."""
    rows = pii_spans(docs)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return rows.select(
        "doc_id",
        *(count(k) for k in BASE_KINDS),
        F.sha2(F.encode(listed(base), "UTF-8"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        F.concat_ws(",", F.transform("spans", lambda s: F.format_number(s["score"], 1))).alias("scores"),
        (F.size("spans") > 0).alias("has_pii"),
    )
