"""PII and secret spans against Python's re, on awkward rows."""

import hashlib
import re

import pytest

from shopmetrics.llm import op1_pii, op7_secrets

TEXTS = [None, "", " ", "mail me: a.b+c@ex-ample.co.uk, x@y, a@b.c_d@e.f", "ip 10.0.0.255 999.1.1.1 1.2.3.4.5.6.7.8 007.1.2.3",
         "card 4539 1488 0343 6467 and 4539-1488-0343-6468, 1234567890123456789012", "é+1 (415) 555-0100 +49 30 1234567- +1",
         "IBAN DE89 3704 0044 0532 0130 00 x GB82WEST12345698765432", "ssn 123-45-6789 " + "x" * 60 + " 123-45-6789", "9" * 5000, "a." * 3000 + "@b.c"]


def luhn(d):
    t = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        t += v - 9 if v > 9 else v
    return t % 10 == 0


def base_pii(t):
    t = t or ""
    digits = lambda m: re.sub("[^0-9]", "", m)
    kinds = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15)]
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, ok) in enumerate(kinds) for m in re.finditer(p, t) if ok(m.group())]
    return ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found))


def sf(spark, tmp_dir, rows):
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, spans string").write.parquet(f"{tmp_dir}/documents.parquet")
    return tmp_dir


def test_pii(spark, tmp_dir):
    rows = [(i, t, None, None, "clash") for i, t in enumerate(TEXTS)] + [(0, None, "en", "s", "")] * 2 + [(None, "x@y.zz", None, None, None)]
    got = op1_pii.op1_pii(spark, sf(spark, tmp_dir, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r["doc_id"]: r for r in got}
    for i, t in enumerate(TEXTS):
        assert by_id[i]["base_sha256"] == hashlib.sha256(base_pii(t).encode()).hexdigest(), t
    assert by_id[None]["n_email"] == 1
    assert by_id[7]["n_iban"] == 2 and by_id[8]["n_ssn"] == 1


SECRETS = [None, "", "password=abc", 'API_KEY: "abcd1234efgh" Token = abcdefgh', "secret = secret: abcdefgh", "AKIA" + "A1" * 8 + " AKIAX",
           "f" * 31 + " " + "0a" * 16, "a" * 4000, "ghp_" + "A" * 36]


def base_secrets(t):
    t = t or ""
    kinds = [("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m.group(2)) >= 8),
             ("access", r"AKIA[A-Z0-9]+", lambda m: len(m.group()) >= 16), ("hex", r"[0-9a-f]+", lambda m: len(m.group()) >= 32)]
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, ok) in enumerate(kinds) for m in re.finditer(p, t) if ok(m)]
    return ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(found))


def test_secrets_and_ledger(spark, tmp_dir):
    rows = [(i, t, None, None, None) for i, t in enumerate(SECRETS)] + [(50 + i, SECRETS[3], "en", "s", "") for i in range(5)] + [(None, SECRETS[5], None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, blob string")
    got = op7_secrets.op7_secrets(spark, sf(spark, tmp_dir, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is not None and r["doc_id"] < 50:
            assert r["base_sha256"] == hashlib.sha256(base_secrets(SECRETS[r["doc_id"]]).encode()).hexdigest()
    folder = f"{tmp_dir}/led"
    op7_secrets.scan(docs, folder).collect()
    before = spark.read.parquet(f"{folder}/ledger/*").count()
    assert before == 6 * len({t or "" for _, t, *_ in rows})
    op7_secrets.scan(docs, folder).collect()  # nothing unseen: nothing scanned
    assert spark.read.parquet(f"{folder}/ledger/*").count() == before
    clean = {r["doc_id"]: r["text"] for r in op7_secrets.redact(docs, f"{tmp_dir}/red").collect()}
    assert clean[3] == '[assign]" [assign]' and clean[0] is None and clean[2] == "password=abc"


def test_empty_tables(spark, tmp_dir):
    d = sf(spark, tmp_dir, [])
    assert op1_pii.op1_pii(spark, d).count() == 0
    assert op7_secrets.op7_secrets(spark, d).count() == 0
