"""Secret scans against the plain use of the same expressions, and the queries derived from them."""

import hashlib
import re
import time

import pytest

from packetmill.llm import secrets

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
TEXTS = [
    "", "no secret here", "token = abc12 password: hunter2222", 'x "ApI_KeY" : "a1b2c3d4e5"', "secret=token: abcdefgh", "secret=token=abcdefgh",
    "AKIA" + "A" * 15 + " AKIA" + "B" * 16, "AKIAKIAKIA" + "9" * 12, "é😀 " + "0123456789abcdef" * 2 + "G" + "f" * 23, "PASSWORD='Zz+/=9.-_'",
    "ſecret=abcdefgh toKen=abcdefgh", "token=éabcdef token\n=abcdef", "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a" * 40, "api-key=abcdefg apikey=abcdefg",
    "eyJhbGciOiJI.eyJzdWIiOiIx.abc", "token:token:token:abcdef", "a" * 24 + "=" + "token=" + "b" * 24, "sk_live_" + "A1" * 10, "AIza" + "x" * 35, "xoxb-1234567890-ab",
    "word " * 4000 + "secret: abcdef0123456789abcdef01 " + "😀" * 50 + " passwd=qwertyu",
]


def plain(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def told(spans):
    return ",".join(f"{secrets.RULES[k].kind}:{a}:{b}" for a, k, b in spans)


@pytest.fixture(scope="module")
def found(spark):
    rows = [(i, t, i) for i, t in enumerate(TEXTS)] + [(100, None, 1), (None, "token=abcdef1", 2), (3, TEXTS[3], 3), (0, "passwd=123456", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    return rows, secrets.find_secrets(docs).collect()


def test_base_spans(found):
    rows, got = found
    want = sorted((str(i), hashlib.sha256(told(plain(t or "")).encode()).hexdigest(), *[
        sum(k == n for _, k, _ in plain(t or "")) for n in range(3)]) for i, t, _ in rows)
    assert sorted((str(r["doc_id"]), r["base_sha256"], r["n_assign"], r["n_access"], r["n_hex"]) for r in got) == want


def test_added_spans(found):
    by_id = {r["doc_id"]: r["spans"] for r in found[1]}
    for text, kind in ((12, "private_key"), (13, "github"), (15, "jwt"), (18, "stripe"), (19, "google"), (20, "slack")):
        assert f"{kind}:0:{len(TEXTS[text])}" in by_id[text].split(",")


def test_replaced_column_and_empty_table(spark, found):
    assert found[1][0].__fields__.count("spans") == 1
    assert secrets.find_secrets(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_queries_hold_for_matches():
    def holds(query, grams):
        if query is True:
            return True
        if isinstance(query, str):
            return query in grams
        return (all if query[0] == "all" else any)(holds(q, grams) for q in query[1])

    for rule in secrets.RULES:
        query = secrets.trigram_query(rule.pattern)
        for text in TEXTS:
            low = text.lower()
            if re.search(rule.pattern, text, re.ASCII):
                assert holds(query, {low[i:i + 3] for i in range(len(low) - 2)}), (rule.kind, text)
    assert secrets.trigram_query("[0-9a-f]{24,}") is True
    assert secrets.trigram_query("abcd") == ("all", ("abc", "bcd"))
    assert secrets.trigram_query("(abc|def)x*ghi") == ("all", (("any", ("abc", "def")), "ghi"))
    assert secrets.trigram_query("ab|xyz") is True


def test_no_rule_has_trigrams(spark):
    docs = spark.createDataFrame([(1, "f" * 30)], "doc_id long, text string")
    row, = secrets.scan(docs, rules=secrets.BASE_RULES[2:]).collect()
    assert [(s["start"], s["end"]) for s in row["found"]] == [(0, 30)]


def test_query_is_native(spark, sf_dir):
    from packetmill.llm.queries import QUERIES

    plan = QUERIES["op1_secrets"](spark, sf_dir)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_very_many_matches_in_one_text(spark):
    """Positions are added up in stretches: sixty thousand matches, with others between that are too short."""
    text = "é ".join(f"token=abc{i:05d} secret=x{i % 7}" for i in range(60_000))
    docs = spark.createDataFrame([(1, text), (2, "f" * 24 + " " + "a" * 30)], "doc_id long, text string")
    start = time.perf_counter()
    got = {r["doc_id"]: r for r in secrets.find_secrets(docs).collect()}
    assert time.perf_counter() - start < 30
    assert got[1]["n_assign"] == 60_000 and got[2]["n_hex"] == 2
    assert got[1]["base_sha256"] == hashlib.sha256(told(plain(text)).encode()).hexdigest()
    for n in (secrets.STRETCH - 1, secrets.STRETCH, secrets.STRETCH + 1, 2 * secrets.STRETCH):
        text = "token=abcdef " * n
        row, = secrets.find_secrets(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
        assert row["base_sha256"] == hashlib.sha256(told(plain(text)).encode()).hexdigest()


def test_texts_stay_where_they_are_when_candidates_are_few(spark):
    docs = spark.createDataFrame([(i, f"text {i} " + ("token=abcdef" if i == 3 else "")) for i in range(50)], "doc_id long, text string")
    plan = secrets.find_secrets(docs)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
