import base64
import hashlib
import random
import re

from gridloom.llm import secret_scan

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def spans(text):
    """Base spans by Python's own matcher: (start, kind, end)."""
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def named(found):
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in found)


def strings(n, seed):
    rng = random.Random(seed)
    return [base64.b64encode(rng.randbytes(24)).decode() for _ in range(n)]


WORDS = "configuration_manager getUserAccountById /usr/local/share/documents internationalisation read-only.properties DatabaseConnectionPool mail3.example.com 2024-05-17/2024-06-30".split()


def test_base_spans_by_brute_force(spark):
    rng = random.Random(5)
    bits = ["token", "Secret", "PASSWD", "api_key", "apikey", "=", ":", " ", "'", '"', "abc", "abcdef1", "AKIA", "AKIA" + "Q7" * 8, "0123456789abcdef" * 2, "é", "\U0001f600", "\n", ".", "x" * 5, "f" * 23]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(300)]
    texts += [None, "", "token=token=abcdef", "secret=token:abcdefgh", "password: 'hunter2hunter2'", "tokentoken=abcdef", "AKIAAKIA" + "Z" * 12, "ſecret=abcdefgh"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r for r in secret_scan.find_secrets(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = spans(t)
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == x for _, k, _ in want) for x in range(3)], t
        assert got[i].base_sha256 == hashlib.sha256(named(want).encode()).hexdigest()
        assert [x for x in got[i].spans.split(",") if x and not x.startswith("markov")] == [x for x in named(want).split(",") if x]


def scored(value, samples):
    """Plain log-likelihood ratio, in thousandths of nats by pair."""
    import math
    from collections import Counter

    logs = {}
    for label in (True, False):
        n = Counter()
        for v, r in samples:
            if r == label:
                n.update(zip(" " + v, v, strict=False))
        one = Counter()
        for (_, b), k in n.items():
            one[b] += k
        total = sum(one.values())
        for a in " " + secret_scan.ALPHABET:
            from_a = sum(n[a, b] for b in secret_scan.ALPHABET)
            for b in secret_scan.ALPHABET:
                share = (one[b] + 1) / (total + len(secret_scan.ALPHABET))
                logs[label, a, b] = math.log((n[a, b] + 20 * share) / (from_a + 20))
    return sum(math.floor(1000 * (logs[True, a, b] - logs[False, a, b]) + 0.5) for a, b in zip(" " + value, value, strict=False))


def test_models_on_held_out_strings(spark):
    train = [(s, True) for s in strings(400, 1)] + [(w + x, False) for w in WORDS for x in ("", "s", "_impl", ".conf", "/index")]
    test = [(s, True) for s in strings(60, 2)] + [(w, False) for w in ("applicationContextProvider", "customer_invoice_number", "/var/log/system/messages", "org.example.service.account", "2023-01-02/2023-03-04.99")]
    df = spark.createDataFrame([(i, f"see {s} there") for i, (s, _) in enumerate(test)], "doc_id long, text string")
    samples = spark.createDataFrame(train, "value string, random boolean")
    got = {r.doc_id: r.spans for r in secret_scan.find_secrets(df, samples).collect()}
    for i, (s, label) in enumerate(test):
        assert got[i] == (f"markov:4:{4 + len(s)}" if scored(s, train) > secret_scan.BOUND else "")
        if not label:
            assert not got[i]
    assert sum(bool(got[i]) for i in range(60)) >= 58


def test_samples_from_the_texts_themselves(spark):
    rng = random.Random(8)
    hidden = strings(30, 3)
    words = [w + x for w in WORDS for x in ("", "s", "_impl", ".conf", "/index", "-default", "AndOthers")]
    rows = [(i, " ".join(rng.choice(words) for _ in range(40)) + (f" at {hidden[i]} end" if i < 30 else "")) for i in range(120)]
    rows += [(1000 + i, f'token = "{hashlib.sha1(str(i).encode()).hexdigest()}"') for i in range(20)]
    got = {r.doc_id: r.spans for r in secret_scan.find_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows[:120]:
        at = t.find(hidden[i]) if i < 30 else -1
        assert not got[i] or i < 30 and got[i] == f"markov:{at}:{at + len(hidden[i])}", t
    assert sum(bool(got[i]) for i in range(30)) >= 28
    assert all(got[1000 + i] == "assign:0:49,hex:9:49" for i in range(20))


def test_odd_rows(spark):
    long = ("word " * 400_000) + "secret: " + "Zq3" * 400 + " " + "ab1" * 700_000  # a run of two million characters
    rows = [(None, None, "x"), (1, "", "y"), (1, "token=abcdef", "z"), (1, "token=abcdef", "z"), (2, long, "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _row string").selectExpr("*", "'own' as spans", "1 as _id", "2 as value")
    got = sorted((r.doc_id or 0, r.n_assign, r.spans[:30]) for r in secret_scan.find_secrets(df).collect())
    assert got[:4] == [(0, 0, ""), (1, 0, ""), (1, 1, "assign:0:12"), (1, 1, "assign:0:12")]
    assert got[4][1] == 1 and got[4][2].startswith("assign:2000000:2001208")
    assert secret_scan.find_secrets(df.limit(0)).count() == 0
