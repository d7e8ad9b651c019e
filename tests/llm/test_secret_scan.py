import hashlib
import math
import random
import re
from collections import Counter

import pytest

from flowlens.llm import queries, secret_scan as s

from .conftest import SF, make_docs, rows_of

ASSIGN = re.compile(s.ASSIGN, re.A)


def base_spans(t):
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    return found + [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]


def entropy_spans(t):
    out = []
    for m in re.finditer(s.CANDIDATE + "+", t):
        c, own = m[0], []
        for i in range(len(c) - s.WINDOW + 1):
            w = c[i:i + s.WINDOW]
            total = sum(round(k * math.log2(k) * s.UNIT) for k in Counter(w).values())
            least = s.THRESHOLDS["hex" if re.fullmatch("[0-9a-fA-F]+", w) else "token"]
            if total <= math.floor(s.WINDOW * s.UNIT * (math.log2(s.WINDOW) - least)):
                if own and own[-1][1] >= i:
                    own[-1][1] = i + s.WINDOW
                else:
                    own.append([i, i + s.WINDOW])
        out += [(m.start() + a, 3, m.start() + z, "entropy") for a, z in own if not any(re.search(p, c[a:z]) for p in s.ALLOWED)]
    return out


def line(spans):
    return ",".join(f"{k}:{a}:{z}" for a, _, z, k in sorted(spans))


def expected(rows):
    out = []
    for i, t in rows:
        base = base_spans(t or "")
        out.append((i, *(sum(x[3] == k for x in base) for k in ("assign", "access", "hex")),
                    hashlib.sha256(line(base).encode()).hexdigest(), line(base + entropy_spans(t or ""))))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def rows(edge_rows):
    r = random.Random(3)
    parts = ["password=hunter22", "TOKEN : 'abc.def/gh'", "token=token:abcdefgh", "secret==x", "api_key:\"0123456789\"", "AKIA" + "Q7" * 8, "AKIAAKIA" + "Z" * 12,
             "deadbeef" * 4, "0" * 30, "é漢😀", " ", "\n", "Zm9vYmFyMTIzNDU2Nzg5MEFCQ0RFRg==", "k3Yx9QpLm2Vt7Rz8Wn4Bs6Hd", "lowercaselettersonlyhere", "passwd=x token=y",
             "123e4567-e89b-12d3-a456-426614174000", "sample-key-8f3kD92mQpX7vB", "=", "ſecret=abcdefg", "api-key=abcdefg"]
    mixed = [(1000 + k, "".join(r.choice(parts) + r.choice(["", " ", ", "]) for _ in range(r.randint(1, 12)))) for k in range(120)]
    noise = "".join(r.choice(s.ALPHABET) for _ in range(4000))
    return edge_rows + mixed + [(2000, noise), (2001, "x " * 3000 + noise[:50] + " y" * 3000), (2002, "password=abcdefgh " * 300)]


def test_report_equals_brute_force(spark, rows):
    assert rows_of(s.report(make_docs(spark, rows))) == expected(rows)


def test_masking(spark, rows):
    docs = make_docs(spark, rows)
    got = s.redact(docs)
    assert got.columns == docs.columns

    def masked(t):
        if not t:
            return t
        out, done = "", 0
        for a, _, z, _ in sorted(base_spans(t) + entropy_spans(t)):
            if a > done or not done:
                out += t[done:a] + s.MARK
            done = max(done, z)
        return out + t[done:]

    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted(((i, masked(t)) for i, t in rows), key=repr)


def test_empty_table_and_native_plan(no_docs, edge_docs):
    assert s.report(no_docs).count() == 0 and s.redact(no_docs).count() == 0
    for df in (s.report(edge_docs), s.redact(edge_docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert rows_of(queries.op9_secret_scan(spark, SF)) == expected(rows)
