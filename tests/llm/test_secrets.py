import hashlib
import re

from hypothesis import given, settings, strategies as st

from clickmill.llm import secrets

ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(found)]


PIECES = st.lists(st.sampled_from([
    "token", "TOKEN", "api_key", "ApiKey", "tOken", "ſecret", "passwd", "password", "=", ": ", " = ", '"', "'", "abc12",
    "abcdef", "0123456789abcdef", "deadbeefdeadbeef", "AKIA", "ABCDEFGHIJ", "A1B2C3D4E5F6G7", " ", "\n", "ß", "😀", ".", "G"]),
    max_size=14).map("".join)


@settings(max_examples=300, deadline=None)
@given(PIECES)
def test_base_spans_match_brute_force(text):
    spans = secrets.find_spans(text, secrets.Novelty())
    assert [f"{k}:{s}:{e}" for s, e, k in spans if k != "novel"] == brute(text)


RANDOM = "q7Zk9Xw2Lp4Vt8Rb1Nc6Hd3Yf5"


def test_novel_strings_in_sensitive_context():
    novelty = secrets.Novelty()
    text = f"set the signature to {RANDOM} now"
    start = text.index(RANDOM)
    assert secrets.find_spans(text, novelty) == [(start, start + len(RANDOM), "novel")]
    # A repeated secret does not foretell itself: each copy in reach of the context is reported.
    thrice = secrets.find_spans(f"{RANDOM} {RANDOM} the signature {RANDOM}", novelty)
    assert thrice == [(0, 26, "novel"), (27, 53, "novel"), (68, 94, "novel")]
    # Without context, or a name: nothing is reported.
    assert not secrets.find_spans(f"set the colour to {RANDOM} now", novelty)
    assert not secrets.find_spans("the private_key of database_connection_user_1", novelty)
    assert novelty.of(text, start, start + len(RANDOM)) > 0.7


def test_summary_and_odd_rows(spark):
    key = "0123456789abcdef" * 2
    text = f'token = "{key}" AKIA{"Z" * 16}'
    docs = spark.createDataFrame(
        [(1, text, 1), (1, text, 1), (None, text, 1), (2, None, 1), (3, "", 1), (4, "x" * 300_000 + f" {key}", 1)],
        "doc_id long, text string, spans int")
    found = secrets.summary(secrets.scan(docs)).collect()
    assert len(found) == 6
    base = ",".join(brute(text))
    for row in found[:3]:
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == (1, 1, 1)
        assert row["base_sha256"] == hashlib.sha256(base.encode()).hexdigest() and row["spans"] == base
    nothing = hashlib.sha256(b"").hexdigest()
    assert [r["base_sha256"] for r in found[3:5]] == [nothing, nothing]
    assert found[5]["spans"] == "hex:300001:300033"
    assert secrets.summary(secrets.scan(docs.limit(0))).collect() == []


def test_redaction(spark):
    key = "0123456789abcdef" * 2
    docs = spark.createDataFrame(
        [(1, f"a token = {key} b {key} c"), (2, None), (3, "clean"), (4, "")], "doc_id long, text string")
    found = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert found == {1: "a [SECRET] b [SECRET] c", 2: None, 3: "clean", 4: ""}


def test_repeated_secrets_do_not_foretell_themselves():
    novelty = secrets.Novelty()
    line = f"curl -H 'Authorization: Bearer {RANDOM}' https://example.com/api\n"
    for times in (1, 2, 5, 40):
        text = line * times
        starts = [m.start() for m in re.finditer(RANDOM, text)]
        assert secrets.find_spans(text, novelty) == [(s, s + len(RANDOM), "novel") for s in starts]
    assert not secrets.find_spans("the private_key of database_connection_user_1\n" * 3, novelty)


def test_long_secrets_are_found_whole():
    import base64
    import random

    novelty = secrets.Novelty()
    packed = base64.b64encode(random.Random(1).randbytes(1190)).decode()
    lines = [packed[i:i + 64] for i in range(0, len(packed), 64)]
    assert len(lines[-1]) < 64
    for tail in (lines[-1], lines[-1][:9]):
        for mark in ("RSA PRIVATE KEY", "PRIVATE KEY"):
            block = [*lines[:-1], tail]
            text = f"-----BEGIN {mark}-----\n" + "\n".join(block) + f"\n-----END {mark}-----\n"
            assert [text[s:e] for s, e, _ in secrets.find_spans(text, novelty)] == block
    token = ["eyJhbGciOiJIUzI1NiIsInR5cCI6IkpXVCJ9", packed[:150].replace("+", "-").replace("/", "_"), packed[200:243].replace("+", "-").replace("/", "_")]
    text = "Authorization: Bearer " + ".".join(token) + " sent"
    assert [text[s:e] for s, e, _ in secrets.find_spans(text, novelty)] == token
    for text in (f"access-key: {RANDOM}", f"api key {RANDOM}", f"{RANDOM} is the signature", f"x {RANDOM}\n# our private-key"):
        assert [text[s:e] for s, e, _ in secrets.find_spans(text, novelty)] == [RANDOM]
    assert not secrets.find_spans(f"{RANDOM} {'far ' * 30} the signature", novelty)
