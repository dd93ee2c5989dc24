"""PII, exact dedup and quality rules against plain Python; their SQL against DuckDB."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from gridloom.llm import exact_dedup, pii, quality_rules, queries

from .conftest import SF

KINDS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        s += v - 9 * (v > 9)
    return s % 10 == 0


def valid(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m.split("."))
    return kind == "email" or (14 <= len(d) <= 19 and luhn(d) if kind == "card" else 10 <= len(d) <= 15)


def base_spans(text):
    out = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(KINDS.items()) for m in re.finditer(p, text or "") if valid(k, m.group())]
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def check_pii(rows, texts):
    for r in rows:
        want = base_spans(texts[r["doc_id"]])
        assert ",".join(p for p in r["spans"].split(",") if p and p.split(":")[0] in KINDS) == want
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(p.startswith(k + ":") for p in want.split(",")) for k in KINDS]


def test_pii_on_documents(docs):
    check_pii(pii.pii_digest(docs).collect(), dict(docs.select("doc_id", "text").collect()))


def test_pii_on_noise(spark):
    r = random.Random(3)
    texts = {i: "".join(r.choice("ab@..@+ 112455-() 0éA%") for _ in range(r.randint(0, 60))) for i in range(3000)}
    texts |= {9000: None, 9001: "", 9002: "a" * 50_000 + "@b.c " + "1" * 50_000 + ".1.2.3 " + "1-" * 50_000, 9003: "4111111111111111 +1 234 567 8901 x@y.zz 1.2.3.4 " * 2000}
    texts |= {9004: "a@b.cd%x@y.z@q.r 1.2.3.4.5.6.7.8 300.1.1.1 001.02.3.255"}
    check_pii(pii.pii_digest(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect(), texts)


def test_pii_more_kinds_and_redaction(spark):
    df = spark.createDataFrame([(1, "iban GB82 WEST 1234 5698 7654 32 tel 212 555 1234 and GB82WEST12345698765433"), (2, "order 212 555 1234"), (3, "mail a@b.co now")], "doc_id long, text string")
    assert {r["doc_id"]: r["spans"] for r in pii.pii_digest(df).collect()} == {1: "iban:5:32,phone_local:37:49", 2: "", 3: "email:5:11"}
    assert {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}[3] == "mail <email> now"


@pytest.mark.parametrize(
    ("text", "spans"),
    [
        ('token = "f33e61083db5dbdf4bd2369d2f80176e57f7fda2" on', "secret:9:49"), ("f33e61083db5dbdf4bd2369d2f80176e57f7fda2", ""), ("password: aaaaaaaaaaaaaaaaaaaaaaaa", ""),
        ("AKIA" + "Q7" * 8, "access_key:0:20"), ("ssn 219-09-9999 or 219-00-9999, social 900-12-1234", "ssn:4:15"), ("219-09-9999", ""),
        ("-----BEGIN RSA PRIVATE KEY-----\nabc=\n-----END RSA PRIVATE KEY----- x", "private_key:0:66"), ("-----BEGIN PUBLIC KEY-----", ""),
        ("see ftp://joe:pw1@host/x", "login:4:18"), ("http://host:80/x@y", ""), ("DE89 3704 0044 0532 0130 00 iban", "iban:0:27"), ("DE88 3704 0044 0532 0130 00 iban", ""),
    ],
)
def test_pii_kinds(spark, text, spans):
    r = pii.pii_digest(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    got = ",".join(x for x in r["spans"].split(",") if x.split(":")[0] not in KINDS)
    assert got == spans and r["n_spans"] == len(r["spans"].split(",")) * bool(r["spans"]) == len(r["scores"].split(",")) * bool(r["scores"])


def redacted(text, spans):
    out, at = "", 0
    for x in filter(None, spans.split(",")):
        kind, start, end = x.split(":")
        if int(start) < at:
            at = max(at, int(end))
            continue
        out, at = out + text[at : int(start)] + f"<{kind}>", int(end)
    return out + text[at:]


def test_redact_by_row(spark):
    """Rows that repeat an id, or have none, and texts with very many spans."""
    rows = [(None, "mail a@b.co now"), (None, "plain"), (1, "hello"), (1, "write to somebody@example.org please"), (2, None), (3, "x@y.zz 1.2.3.4 é +1 234 567 8901;" * 400), (4, "u://a:b@c.de 4111111111111111")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = [(r["doc_id"], r["spans"]) for r in pii.pii_digest(df).collect()]  # in the order of the rows
    got = [(r["doc_id"], r["text"]) for r in pii.redact(df).collect()]
    assert got == [(i, redacted(t or "", s)) for (i, t), (_, s) in zip(rows, spans, strict=True)]
    assert got[0] == (None, "mail <email> now") and got[3][1] == "write to <email> please"


def test_pii_odd(odd):
    got = pii.pii_digest(odd)
    assert got.count() == odd.count() and got.filter("n_email = 1").count() == 1
    assert pii.pii_digest(odd.limit(0)).count() == 0


def low(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def test_exact_dedup(docs):
    groups = defaultdict(list)
    for r in docs.collect():
        groups[low(r["text"])].append(r["doc_id"])
    for r in exact_dedup.exact_duplicates(docs).collect():
        g = next(v for v in groups.values() if r["doc_id"] in v)
        assert (r["keep_id"], r["group_size"], r["kept"]) == (max(g), len(g), r["doc_id"] == max(g))
    assert sorted(r["doc_id"] for r in exact_dedup.drop_exact_duplicates(docs).collect()) == sorted(max(g) for g in groups.values())


def test_exact_dedup_odd(odd):
    got = exact_dedup.exact_duplicates(odd).collect()
    same = [r for r in got if r["keep_id"] == 2]
    assert len(same) == 3 and sum(r["kept"] for r in same) == 1
    empty = [r for r in got if r["text_sha256"] == hashlib.sha256(b"").hexdigest()]
    assert {r["keep_id"] for r in empty} == {3} and sum(r["kept"] for r in empty) == 1
    left = exact_dedup.drop_exact_duplicates(odd.unionByName(odd))
    assert left.columns == odd.columns and left.count() == sum(r["kept"] for r in got)
    assert exact_dedup.exact_duplicates(odd.limit(0)).count() == 0 and exact_dedup.drop_exact_duplicates(odd.limit(0)).count() == 0


def test_exact_dedup_by_shuffle(docs, monkeypatch):
    """The same rows when nothing is frequent enough or small enough to be broadcast."""
    want = sorted(r["doc_id"] for r in exact_dedup.drop_exact_duplicates(docs).collect())
    monkeypatch.setattr("gridloom.llm.shared.broadcast_if_small.__defaults__", (0,))
    assert sorted(r["doc_id"] for r in exact_dedup.drop_exact_duplicates(docs).collect()) == want


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    marked = {j for i, g in enumerate(zip(words, words[1:], words[2:], strict=False)) if grams[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked)


def test_quality_rules(docs, odd):
    for df in (docs, odd.filter("doc_id is not null").dropDuplicates(["doc_id"])):
        texts = dict(df.select("doc_id", "text").collect())
        for r in quality_rules.quality_rules(df).collect():
            m = measures(texts[r["doc_id"]])
            assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == m
            assert r["base_failed"] == (m[0] < 50 or 100 * m[4] > 50 * m[0])
            assert not (r["kept"] and r["base_failed"])
    assert quality_rules.quality_rules(odd).count() == odd.count() and quality_rules.quality_rules(odd.limit(0)).count() == 0
    assert quality_rules.keep_good(odd).columns == odd.columns


def test_equal_hashes(docs, monkeypatch):
    """Windows that share a hash are told apart by their words."""
    from pyspark.sql import functions as F

    texts = {i: t for i, t in docs.select("doc_id", "text").collect() if len(t or "") < 5000}
    some = docs.filter("length(text) < 5000")
    monkeypatch.setattr(quality_rules, "paired", lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(40)))
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality_rules.measures(some).collect()}
    assert got == {i: measures(texts[i])[4] for i in got}


def test_keep_good_by_row(spark, docs):
    """A good and a bad text under one id, and under none."""
    passed = {r["doc_id"]: r["kept"] for r in quality_rules.quality_rules(docs).collect()}
    rows = [(r["text"], r["lang"], passed[r["doc_id"]]) for r in docs.collect()]
    want = sorted((t or "", lang or "") for t, lang, ok in rows if ok)
    for i in (5, None):
        from pyspark.sql import functions as F

        kept = quality_rules.keep_good(docs.withColumn("doc_id", F.lit(i).cast("long")))
        assert sorted((r["text"] or "", r["lang"] or "") for r in kept.collect()) == want


def test_divergence(spark):
    df = spark.createDataFrame([([0.5, 0.5, 0.0], [0.5, 0.5, 0.0], [0.0, 0.0, 1.0])], "p array<double>, q array<double>, r array<double>")
    r = df.select(quality_rules.distance(df.p, df.q).alias("same"), quality_rules.distance(df.p, df.r).alias("far")).first()
    assert r["same"] == 0 and math.isclose(r["far"], 1)


def test_quality_keeps_clean_and_finds_junk(spark):
    sf = "/root/testdata/sf0.01"
    got = quality_rules.quality_rules(spark.read.parquet(f"{sf}/documents.parquet")).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    long = got[~got["base_failed"]]
    assert long[long.quality == 1]["kept"].mean() > 0.99 and long[long.quality == 0]["kept"].mean() < 0.2


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    df = queries.QUERIES[name](spark, SF)
    found = con.execute(queries.SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    want = sorted(found.fetchall())
    assert sorted(tuple(r[n] for n in names) for r in df.collect()) == want
