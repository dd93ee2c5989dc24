"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust their score.

Four base kinds (email, ip, card, phone) stay whatever their score.  More kinds
are proposed too, ``iban``, ``phone_local``, ``ssn``, ``secret`` (keys and tokens
by their make), ``access_key`` (by their known beginnings), ``private_key`` and
``login`` (in a URL); they stay at a score of ``MIN_SCORE`` or more unless they
lie inside a base span.

Every pattern is written so that one search is linear in the text: a run is
entered only at its start, and repeats are possessive.  Places come from the
lengths of the pieces between the matches, summed in blocks.

Defined results: a null or empty text has no spans, and base_sha256 is that of
the empty string; places are code points; repeated rows give the same spans
each, and of rows that share an id each has its own; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL, TOKEN = r"[A-Za-z0-9._%+-]", "[A-Za-z0-9+/_-]"
#: kind: (pattern, text without which it cannot match)
KINDS = {
    "email": (rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}", "."),
    # Whole chains of digits with 14 to 19 of them: no other can be a card.
    "card": (r"[0-9](?<![0-9][0-9])(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])", None),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", None),
    "phone_local": (r"(?<![0-9+(.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])", None),
    "ssn": (r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-"),
    "secret": (rf"(?<!{TOKEN}){TOKEN}{{16,128}}+(?!{TOKEN})", None),
    "access_key": (r"(?<![A-Za-z0-9_])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|[rs]k_live_[A-Za-z0-9]{24,}+|xox[abprs]-[A-Za-z0-9-]{10,}+|AIza[A-Za-z0-9_-]{35})(?![A-Za-z0-9_])", None),
    "private_key": (r"-----BEGIN (?:[A-Z]{1,16}+\x20)?PRIVATE KEY-----(?:[A-Za-z0-9+/=\x20\x09-\x0D]*+-----END (?:[A-Z]{1,16}+\x20)?PRIVATE KEY-----)?", "PRIVATE KEY-----"),
    "login": (r"(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]{1,31}+://[^\x20\x09-\x0D/:@]{1,128}+:[^\x20\x09-\x0D/@]{1,128}+@", "://"),
}
BASE = ("email", "ip", "card", "phone")
#: The score that a pattern alone gives, and words near a span.
PRIOR = {"email": 0.7, "ip": 0.5, "card": 0.4, "phone": 0.6, "iban": 0.3, "phone_local": 0.4, "ssn": 0.2, "secret": 0.2, "access_key": 0.4, "private_key": 0.4, "login": 0.4}
NEAR = {
    "email": ["mail", "contact", "write"],
    "ip": ["ip", "host", "server", "address"],
    "card": ["card", "visa", "credit", "karte", "carte", "tarjeta"],
    "phone": ["tel", "phone", "call", "mobile", "fax"],
    "iban": ["iban", "account", "konto", "compte", "cuenta"],
    "phone_local": ["tel", "phone", "call", "mobile", "fax"],
    "ssn": ["ssn", "social", "security"],
    "secret": ["token", "secret", "password", "passwd", "pwd", "api", "key", "auth", "bearer", "credential"],
    "access_key": ["key", "token", "secret"],
    "private_key": ["key"],
    "login": ["login", "user", "password", "url"],
}
AGAINST = ["order", "invoice", "version", "isbn", "serial"]
CONFIRMED, NEARBY, MIN_SCORE, CONTEXT = 0.3, 0.2, 0.6, 40
#: Lengths are summed in blocks of this many, then across blocks.
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def running_sums(steps: Column) -> Column:
    """Sums up to and with each element; ``steps`` must not be empty."""
    zero = F.array(F.lit(0).cast("long"))
    add = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))

    def over(s: Column) -> Column:
        first = F.sequence(F.lit(1), F.size(s), F.lit(BLOCK))
        return F.transform(F.transform(first, lambda k: F.slice(s, k, F.lit(BLOCK))), lambda block: F.aggregate(block, zero, add))

    def joined(blocks: Column) -> Column:
        before = F.aggregate(blocks, zero, lambda acc, b: add(acc, F.element_at(b, -1)))
        return let(before, lambda z: F.flatten(F.transform(blocks, lambda b, i: F.transform(F.slice(b, F.lit(2), F.size(b)), lambda v: v + z[i]))))

    return let(let(steps, over), joined)


def mod97(s: Column) -> Column:
    """Whether letters and digits, the first four moved to the end, are 1 modulo 97 with A as 10 to Z as 35."""
    moved = F.concat(F.substring(s, 5, 64), F.substring(s, 1, 4))
    digit = lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
    step = lambda r, v: F.when(v < 10, r * 10 + v).otherwise(r * 100 + v) % 97
    chars = F.transform(F.sequence(F.lit(1), F.length(moved)), lambda i: digit(F.substr(moved, i, F.lit(1))))
    return F.aggregate(chars, F.lit(0), step) == 1


def confirmed(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(found, r"\."), lambda x: x.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})$"))
    if kind == "card":
        return F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        return mod97(F.regexp_replace(found, " ", ""))
    if kind == "ssn":  # areas, groups and serials that are never given out
        return ~found.rlike("^(?:000|666|9)|-00-|-0000$")
    if kind == "secret":  # letters and digits mixed as by chance
        some = lambda of: F.length(F.regexp_replace(found, f"[^{of}]", ""))
        return (some("0-9") >= 3) & (some("A-Za-z") >= 3) & (F.size(F.array_distinct(F.split(found, ""))) >= 10)
    return F.lit(kind in ("email", "access_key", "private_key", "login"))


def spans_of(kind: str, text: Column, found: Column, between: Column) -> Column:
    """Array of struct(start, rank, end, kind, score, sure) of the matches ``found``, with the pieces ``between`` them."""
    steps = F.transform(found, lambda m, i: (F.length(F.get(between, i)) + F.length(m)).cast("long"))
    near, against = ("(?i)(?<![a-z])(?:" + "|".join(words) + ")" for words in (NEAR[kind], AGAINST))

    def one(m: Column, i: Column, ends: Column) -> Column:
        context = F.concat_ws(" ", F.right(F.get(between, i), F.lit(CONTEXT)), F.left(F.get(between, i + 1), F.lit(CONTEXT)))
        sure = confirmed(kind, m)
        score = PRIOR[kind] + F.when(sure, CONFIRMED).otherwise(0.0) + F.when(context.rlike(near), NEARBY).otherwise(0.0) - F.when(context.rlike(against), NEARBY).otherwise(0.0)
        return F.struct(
            (ends[i] - F.length(m)).alias("start"), F.lit(list(KINDS).index(kind)).alias("rank"), ends[i].alias("end"),
            F.lit(kind).alias("kind"), F.round(score, 2).alias("score"), sure.alias("sure"),
        )

    return let(running_sums(steps), lambda ends: F.transform(found, lambda m, i: one(m, i, ends)))


def _with_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, t (the text, null as empty) and spans of each row."""
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string,score:double,sure:boolean>>")
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    none = F.array().cast("array<string>")
    for kind, (pattern, needs) in KINDS.items():
        found = F.regexp_extract_all("t", F.lit(pattern), F.lit(0))
        df = df.withColumn(f"m_{kind}", F.when(F.instr("t", needs) > 0, found).otherwise(none) if needs else found)
    for kind, (pattern, _) in KINDS.items():
        df = df.withColumn(f"p_{kind}", F.when(F.size(f"m_{kind}") > 0, F.split("t", pattern, -1)).otherwise(none))
    for kind in KINDS:
        spans = spans_of(kind, F.col("t"), F.col(f"m_{kind}"), F.col(f"p_{kind}"))
        df = df.withColumn(f"s_{kind}", F.when(F.size(f"m_{kind}") > 0, spans).otherwise(empty))
    base = F.sort_array(F.filter(F.concat(*(F.col(f"s_{k}") for k in BASE)), lambda e: e["sure"]))
    df = df.withColumn("base", base)
    others = [k for k in KINDS if k not in BASE]
    more = F.filter(F.concat(*(F.col(f"s_{k}") for k in others)), lambda e: (e["score"] >= MIN_SCORE) & ~F.exists(F.col("base"), lambda b: (b["start"] <= e["start"]) & (e["end"] <= b["end"])))
    some = F.lit(False)
    for k in others:
        some = some | (F.size(f"m_{k}") > 0)
    return df.select("doc_id", "t", F.when(some, F.sort_array(F.concat("base", more))).otherwise(F.col("base")).alias("spans"))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, and ``spans`` as an array of struct(start, rank, end, kind, score, sure), in order."""
    return _with_spans(docs, id_col, text_col).select("doc_id", "spans")


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda e: F.concat_ws(":", e["kind"], e["start"].cast("string"), e["end"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id and its text with each span replaced by its kind in angle brackets; of overlapping spans the first is named."""
    text = F.col("t")

    def add(acc: Column, e: Column) -> Column:
        covered = F.struct(acc["out"].alias("out"), F.greatest(acc["at"], e["end"]).alias("at"))
        between = F.substr(text, (acc["at"] + 1).cast("int"), (e["start"] - acc["at"]).cast("int"))
        return F.when(e["start"] < acc["at"], covered).otherwise(F.struct(F.concat(acc["out"], between, F.lit("<"), e["kind"], F.lit(">")).alias("out"), e["end"].alias("at")))

    def over(acc: Column, block: Column) -> Column:
        part = F.aggregate(block, F.struct(F.lit("").alias("out"), acc["at"].alias("at")), add)
        return let(part, lambda r: F.struct(F.concat(acc["parts"], F.array(r["out"])).alias("parts"), r["at"].alias("at")))

    start = F.struct(F.array().cast("array<string>").alias("parts"), F.lit(0).cast("long").alias("at"))
    blocks = F.transform(F.sequence(F.lit(1), F.size("spans"), F.lit(BLOCK)), lambda k: F.slice("spans", k, F.lit(BLOCK)))
    whole = F.aggregate(blocks, start, over, lambda acc: F.concat(F.array_join(acc["parts"], ""), F.substr(text, (acc["at"] + 1).cast("int"))))
    return _with_spans(docs, id_col, text_col).select("doc_id", F.when(F.size("spans") > 0, whole).otherwise(text).alias("text"))


def pii_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of the base kinds, base_sha256, all spans as text; n_spans and the scores of all spans in their order."""
    df = find_pii(docs, id_col, text_col)
    only = lambda k: F.filter("spans", lambda e: e["kind"] == k)
    base = F.filter("spans", lambda e: e["rank"] < len(BASE))
    scores = F.array_join(F.transform("spans", lambda e: F.format_string("%.2f", e["score"])), ",")
    return df.select(
        "doc_id", *(F.size(only(k)).cast("long").alias(f"n_{k}") for k in BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"), scores.alias("scores"),
    )
