"""Secrets against plain patterns over whole texts."""

import random

from shelfcast.llm import secret_scan as S


def plain(text):
    spans = [(m.start(), m.end(), "assign") for m in S.ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), m.end(), "access") for m in S.ACCESS.finditer(text) if len(m[0]) >= 18]
    spans += [(m.start(), m.end(), "hex") for m in S.re.finditer("[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return sorted(spans, key=lambda s: (s[0], S.KINDS.index(s[2])))


def found(text):
    return [s for s in S.find(text, S.keyword_automaton()) if s[2] in S.BASE]


def test_random_texts():
    rng = random.Random(5)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", "apikey", "=", ":", " ", '"', "'",
             "AKIA", "akia", "ABCD1234", "abcdef0123", "deadbeef", "é", "İ", "ſ", "K", "/+", ".", "\n", "xyz"]
    hits = 0
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randrange(1, 40)))
        assert found(text) == plain(text), text
        hits += len(plain(text))
    assert hits > 500


def test_match_that_fails_uses_its_characters():
    text = "secret=token=abc password=secret=abcdefghijklmnop"
    assert found(text) == plain(text)


def test_checksums():
    body = "A1b2C3d4E5" * 3
    good = f"ghp_{body}{S.crc_base62(body)}"
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    finder = S.keyword_automaton()
    assert [s[2] for s in S.find(f"x {good} y", finder)] == ["checked"]
    assert S.find(f"x {bad} y", finder) == []
    part = lambda d: S.base64.urlsafe_b64encode(S.json.dumps(d).encode()).decode().rstrip("=")
    signed = f"{part({'alg': 'HS256'})}.{part({'sub': 1})}.{'s' * 20}"
    assert [s[2] for s in S.find(signed, finder)] == ["signed"]
    assert S.find(signed.replace("eyJhbGci", "eyJhbGc!"), finder) == []
    assert [s[2] for s in S.find("-----BEGIN RSA PRIVATE KEY-----", finder)] == ["private"]


def redacted(text):
    return S.redact(text, S.find(text, S.keyword_automaton()))


def test_private_keys_go_whole():
    rng = random.Random(7)
    body = ["".join(rng.choices(S.BASE62 + "+/", k=64)) for _ in range(9)] + ["Qx7/abcdEFG="]
    for label in ("PRIVATE KEY", "RSA PRIVATE KEY", "ENCRYPTED PRIVATE KEY", "PGP PRIVATE KEY BLOCK"):
        for fields in ([], ["Proc-Type: 4,ENCRYPTED", "DEK-Info: AES-128-CBC,0A1B", ""], ["Version: GnuPG v2", ""]):
            for end in ([f"-----END {label}-----"], []):
                key = [f"-----BEGIN {label}-----", *fields, *body, *end]
                for sep in ("\n", "\r\n", "\\n", "\n    ", "\n> "):
                    text = f"before {sep.join(key)}\n\nafter it"
                    assert redacted(text) == "before <private>\n\nafter it", text
                if not fields:
                    assert redacted(f"before {' '.join(key)} after it") == "before <private> after it"


def test_private_key_is_cut_where_it_breaks_off():
    head, line = "-----BEGIN EC PRIVATE KEY-----", "AbC1" * 16
    assert redacted(f"{head}\n{line}\nshort") == "<private>"
    assert redacted(f"the line {head} opens a key\n") == "the line <private> opens a key\n"
    assert redacted(f"{head}\n{line}\n{head}\n{line}\n-----END EC PRIVATE KEY-----.") == "<private>\n<private>."
    assert redacted(f"{head}\n{line}\n-----END CERTIFICATE-----") == "<private>\n-----END CERTIFICATE-----"
    many = f"{head} a\n" * 20_000
    assert redacted(many) == "<private> a\n" * 20_000


def test_redaction():
    text = "a password=abcdefghijklmnopqr b"
    spans = S.find(text, S.keyword_automaton())
    assert S.redact(text, spans) == "a <assign> b"


def test_rows(spark):
    rows = [(1, "k token: abcdefabcdefabcdef", 5), (None, None, None), (1, "", 2), (1, "", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, secrets long")
    got = S.scan_secrets(docs)
    assert got.columns == ["doc_id", "text", "secrets", "redacted"]
    by_text = {r.text: r for r in got.collect()}
    assert by_text[None].redacted is None and by_text[None].secrets == []
    assert by_text[""].redacted == "" and got.count() == 4
    spelled = got.select(S.spelled("secrets").alias("s"), S.count_kind("secrets", "hex").alias("n"))
    assert ("assign:2:27,hex:9:27", 1) in [tuple(r) for r in spelled.collect()]
    assert S.scan_secrets(docs.limit(0)).collect() == []
