"""Secret scan: base spans against regular expressions, and what the
randomness battery adds."""

import hashlib
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from gridplace.llm import secret_scan as S
from gridplace.llm.secret_scan import secret_scan

from .rows import by_id, frame, hard_rows

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans)]


def odd_rows():
    rnd = random.Random(9)
    bits = ["token", "Secret", "pass", "password", "API_KEY", "apikey", "=", ":", " ", '"', "'", "AKIA", "A1B2C3D4", "0123456789ab", "cdef", "日", "😀", "\n", "x.y", "-"]
    return [(1000 + i, "".join(rnd.choice(bits) for _ in range(rnd.randrange(0, 25)))) for i in range(400)] + [
        (2000, "token=token:abcdefgh PassWord: \"é日本\" api_key=abc123def"), (2001, "xAKIA" + "A1" * 10 + " " + "deadbeef" * 10 + " " + "0123456789abcdef" * 3), (2002, "ſecret = abcdefgh"),
    ]


def test_base_spans_equal_the_patterns(spark):
    rows = odd_rows() + hard_rows()
    got = secret_scan(frame(spark, rows)).collect()
    want = []
    for i, t in rows:
        spans = base(t)
        kinds = [s.split(":")[0] for s in spans]
        want.append((i, *(kinds.count(k) for k in ("assign", "access", "hex")), hashlib.sha256(",".join(spans).encode()).hexdigest()))
    assert by_id((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == by_id(want)
    # the base spans are all still there, in their order
    assert by_id((r.doc_id, ",".join(s for s in r.spans.split(",") if not s.startswith("random"))) for r in got) == by_id((i, ",".join(base(t))) for i, t in rows)
    starts = [[int(s.split(":")[1]) for s in r.spans.split(",") if s] for r in got]
    assert all(s == sorted(s) for s in starts)
    assert secret_scan(frame(spark, [])).collect() == []


def test_random_strings_are_added_and_words_are_not(spark):
    rnd = random.Random(2)
    key = lambda alphabet, n: "".join(rnd.choice(alphabet) for _ in range(n))
    secrets = [(i, f"see 日 {key(B64[:62], rnd.choice([32, 44, 64]))} here") for i in range(150)]
    secrets += [(200 + i, "key " + key("0123456789ABCDEF", 40)) for i in range(50)]
    syllables = ["An", "the", "er", "ing", "Data", "Base", "view", "Str", "2", "src", "main", "Controller"]
    words = [(1000 + i, "/".join("".join(rnd.choice(syllables) for _ in range(5)) for _ in range(4))) for i in range(200)]
    words += [(2000, "Internationalization" * 3), (2001, "1234567890" * 4), (2002, "abababab1A" * 6)]
    rows = secret_scan(frame(spark, secrets + words)).collect()
    found = {r.doc_id for r in rows if r.n_random}
    assert len(found & {i for i, _ in secrets}) >= 0.95 * len(secrets)
    assert len(found & {i for i, _ in words}) <= 0.05 * len(words)
    spans = {r.doc_id: r.spans for r in rows}
    kind, a, b = spans[0].split(":")
    assert kind == "random" and secrets[0][1][int(a) : int(b)].strip() == secrets[0][1][int(a) : int(b)]


def test_short_and_digitless_random_strings_are_tested(spark):
    rnd = random.Random(4)
    key = lambda alphabet, n: "".join(rnd.choice(alphabet) for _ in range(n))
    short = [(i, f"see {key('0123456789abcdef', 20 + i % 3)} here") for i in range(60)]
    letters = [(100 + i, f"see {key(B64[:52], rnd.choice([20, 22, 32]))} here") for i in range(60)]
    coded = [(200 + i, f"see {key(B64[:52] + '-_', 24)} here") for i in range(60)]
    parts = ["Internationalization", "Controller", "Repository", "Transaction", "Statement", "Initializer", "Permission", "Address"]
    words = [(1000 + i, "".join(rnd.sample(parts, 4))) for i in range(60)] + [(2000, "internationalization" * 2), (2001, "1234567890" * 3)]
    found = {r.doc_id for r in secret_scan(frame(spark, short + letters + coded + words)).collect() if r.n_random}
    for rows in (short, letters, coded):
        assert len(found & {i for i, _ in rows}) >= 0.95 * len(rows)
    assert len(found & {i for i, _ in words}) <= 0.05 * len(words)


def test_no_python_in_the_plan(spark):
    text = secret_scan(frame(spark, odd_rows()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


# --- the battery against plain Python ------------------------------------------------


def tail(z):
    z = max(min(z, 8.0), -8.0)
    return 1 / (1 + math.exp(z * 1.5976 + z**3 * 0.070565992))


def far_tail(z):
    z = min(z, 12.0)
    return tail(z) if z < 3 else math.exp(-z * z / 2) / (z * math.sqrt(2 * math.pi))


def plain_encoding(t):
    digit, lower, upper = any(c.isdigit() for c in t), any(c.islower() for c in t), any(c.isupper() for c in t)
    one_case = digit and lower != upper
    if one_case and (set(t) <= set("0123456789abcdef") or set(t) <= set("0123456789ABCDEF")):
        return "hex"
    if digit and upper and set(t) <= set("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"):
        return "base32"
    if one_case and t.isalnum():
        return "base36"
    return "base64" if digit and lower and upper else "letters" if lower and upper else None


def plain_battery(t, encoding):
    alphabet = S.ALPHABETS[encoding]
    t = t.lower() if encoding in ("hex", "base36") else t.replace("-", "+").replace("_", "/") if encoding in ("base64", "letters") else t
    a, n = len(alphabet), len(t)
    x = [alphabet.index(c) + 1 for c in t]
    chi = (sum(a / n * x.count(v) ** 2 for v in set(x)) - n - (a - 1)) / math.sqrt(2 * (a - 1) * (n - 1) / n)
    high = [v > a // 2 for v in x]
    ones = sum(high)
    expect = 2 * ones * (n - ones) / n + 1
    spread = (expect - 1) * (expect - 2) / (n - 1)
    runs = (sum(p != q for p, q in zip(high, high[1:])) + 1 - expect) / math.sqrt(max(spread, 1e-9)) if spread > 0 else 8.0
    mean = sum(x) / n
    total = sum((v - mean) ** 2 for v in x)
    serial = (sum((p - mean) * (q - mean) for p, q in zip(x, x[1:])) / total + 1 / n) * math.sqrt(n) if total > 1e-6 else 8.0
    half = -sum(math.log(p) for p in (tail(chi), min(1.0, 2 * tail(abs(runs))), min(1.0, 2 * tail(abs(serial)))))
    return math.exp(-half) * (1 + half + half * half / 2)


def plain_as_words(t, encoding):
    ratio, mean, deviation = S.letter_model()
    t = t.lower()
    letters = [ord(c) - 97 for c in t if "a" <= c <= "z"]
    z = (len(letters) * mean - sum(ratio[i] for i in letters)) / (deviation * S.SPREAD * math.sqrt(max(1, len(letters))))
    switches = sum((p.isalpha() and q.isdigit()) or (p.isdigit() and q.isalpha()) for p, q in zip(t, t[1:]))
    p_letters, p_switches = far_tail(z), far_tail(2 * (math.sqrt(switches) - math.sqrt(len(t) / S.SWITCH_EVERY)))
    if encoding == "hex" or not letters:
        return p_switches
    if encoding == "letters":
        return p_letters
    against = -math.log(p_letters) - math.log(p_switches)
    return math.exp(-against) * (1 + against)


def strings(seed):
    rnd = random.Random(seed)
    pick = lambda alphabet, n: "".join(rnd.choice(alphabet) for _ in range(n))
    out = [pick(alphabet, rnd.choice([20, 21, 33, 64, 300])) for alphabet in (*S.ALPHABETS.values(), B64 + "-_", "aB1", "ab1", "AB1-", "aaaaaaB") for _ in range(12)]
    return out + ["Ab1" * 9, "aA" * 15, "a" * 30 + "1", "A" * 25 + "b", "1" * 30 + "F", "Internationalization" * 2]


def test_statistics_equal_plain_python(spark):
    rows = [(t, plain_encoding(t)) for t in strings(5)]
    df = spark.createDataFrame([(t,) for t, _ in rows], "value string").withColumn("encoding", S.inferred(F.col("value")))
    found = {r.value: r for r in S.as_words(S.battery(df.filter("encoding IS NOT NULL"))).collect()}
    assert {t for t, e in rows if e} == set(found)
    for t, e in rows:
        if e:
            assert found[t].encoding == e
            assert found[t].p == pytest.approx(plain_battery(t, e), rel=1e-6, abs=1e-12), t
            assert found[t].p_words == pytest.approx(plain_as_words(t, e), rel=1e-6, abs=1e-12), t


def test_cut_offs_equal_the_step_up_rule(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["hex", "base64"]), rnd.choice([4, 5]), int(min(S.BINS - 1, rnd.expovariate(1 / rnd.choice([15, 15, 15, 300]))))) for _ in range(3000)]
    got = {(r.encoding, r.octave): r.reject_bin for r in S.cut_offs(spark.createDataFrame(rows, "encoding string, octave int, bin int"), "bin", 0.05).collect()}
    want = {}
    for stratum in {r[:2] for r in rows}:
        bins = sorted((b for *s, b in rows if tuple(s) == stratum), reverse=True)  # smallest p first
        passed = [b for b in set(bins) if math.exp(-b / S.BINS_PER_E) <= 0.05 * sum(x >= b for x in bins) / len(bins)]
        if passed:
            want[stratum] = min(passed)
    assert got == want and want


def test_false_alarms_among_identifiers_are_few(spark):
    """Camel-case identifiers thirty times as many as random keys."""
    rnd = random.Random(11)
    parts = "get set find load user name order item list map data value index cache query table column filter window join parse token stream batch worker thread result config session manager handler factory".split()
    def identifier():
        out = ""
        while len(out) < 20:
            out += rnd.choice(parts).capitalize() + ("" if rnd.random() < 0.9 else str(rnd.randrange(100)))
        return out[:1].lower() + out[1:]
    words = [(i, f"call {identifier()} here") for i in range(3000)]
    keys = [(10_000 + i, f"call {''.join(rnd.choice(B64[:62]) for _ in range(rnd.choice([24, 32, 40])))} here") for i in range(100)]
    found = {r.doc_id for r in secret_scan(frame(spark, words + keys)).collect() if r.n_random}
    hits = len(found & {i for i, _ in keys})
    assert hits >= 90 and hits / len(found) >= 0.9, (hits, len(found))


def test_one_very_long_run_takes_time_in_proportion(spark):
    rnd = random.Random(1)
    df = spark.createDataFrame([(1, "x " + "".join(rnd.choices(B64, k=1 << 20)) + " y")], "doc_id long, text string")
    secret_scan(spark.createDataFrame([(1, "x " + "".join(rnd.choices(B64, k=100)))], "doc_id long, text string")).collect()  # compiled
    began = time.time()
    assert [r.spans for r in secret_scan(df).collect()] == [f"random:2:{2 + (1 << 20)}"]
    assert time.time() - began < 20  # 4 s on an idle machine
