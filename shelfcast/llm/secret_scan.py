"""Secrets in text: keyword prefilter, anchored patterns at the hits, checksums."""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Callable

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.llm.decontamination import lower_ascii
from shelfcast.llm.shared import map_texts

#: The base patterns and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_CHARS, ACCESS_CHARS = 12, 18

#: Token prefixes whose last six characters are a base-62 CRC-32 of the rest.
CHECKED = re.compile(r"(?:ghp|gho|ghu|ghs|ghr|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
SIGNED = re.compile(r"(eyJ[A-Za-z0-9_-]+)\.(eyJ[A-Za-z0-9_-]+)\.[A-Za-z0-9_-]{16,}")
#: A private key from its header to the END line of the same label. Without one it goes on over
#: fields (``Name: value``) and the base64 run: pieces of 16 characters or more, shorter lines right
#: below them, and a last short piece that is no plain word. Lines may be quoted, indented or escaped.
_BREAK = r"""[\x20\t"',;]*+(?:\\r)?(?:\r\n?|\n|\\n)[\x20\t>#|"'*]*+"""
_BETWEEN = r"""(?:\\[nrt]|[\s>#|"',;*]|\+(?![A-Za-z0-9+/=]))++"""
_LONG = rf"{_BETWEEN}[A-Za-z0-9+/=]{{16,}}+"
_LINE = rf"""{_BREAK}[A-Za-z0-9+/=]++(?=[\x20\t"',;]*+(?:[\r\n]|\\[rn]|\Z))"""
PRIVATE = re.compile(
    r"-----BEGIN (?P<label>(?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?)-----"
    r"(?:(?:(?!-----(?:BEGIN|END) ).)*+-----END (?P=label)-----"
    rf"|(?:{_BREAK}[A-Za-z][A-Za-z0-9-]*+:\x20(?:(?!\\n)[^\r\n])*+)*+"
    rf"(?:{_LONG}(?:{_LONG}|{_LINE})*+(?:{_BETWEEN}(?=[A-Za-z]*[0-9+/=])[A-Za-z0-9+/=]++)?)?)",
    re.DOTALL,
)

#: Keyword (lower case) to kind: a pattern is tried only where one of its keywords starts.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "checked": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
    "signed": ("eyj",),
    "private": ("-----begin ",),
}
#: Order of kinds at one start; the base kinds first.
KINDS = ("assign", "access", "hex", "checked", "signed", "private")
BASE = KINDS[:3]


def crc_base62(body: str) -> str:
    """CRC-32 of ``body`` in six base-62 digits."""
    value, digits = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def _json_object(part: str) -> bool:
    try:
        return isinstance(json.loads(base64.urlsafe_b64decode(part + "=" * (-len(part) % 4))), dict)
    except ValueError:
        return False


RULES: dict[str, tuple[re.Pattern, Callable[[re.Match], bool]]] = {
    "assign": (ASSIGN, lambda m: len(m[2]) >= ASSIGN_CHARS),
    "access": (ACCESS, lambda m: len(m[0]) >= ACCESS_CHARS),
    "checked": (CHECKED, lambda m: crc_base62(m[1]) == m[2]),
    "signed": (SIGNED, lambda m: _json_object(m[1]) and _json_object(m[2])),
    "private": (PRIVATE, lambda m: True),
}


def keyword_automaton() -> ahocorasick.Automaton:
    finder = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            finder.add_word(word, (len(word), kind))
    finder.make_automaton()
    return finder


def find(text: str, finder: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, by start and kind.

    Matches of a kind do not overlap, the leftmost wins, and one that fails its check still uses
    up its characters, as when the pattern runs over the whole text.
    """
    starts: dict[str, list[int]] = {}
    for end, (n, kind) in finder.iter(lower_ascii(text)):
        starts.setdefault(kind, []).append(end - n + 1)
    spans = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    for kind, places in starts.items():
        pattern, valid = RULES[kind]
        free = 0
        for at in sorted(places):
            if at >= free and (m := pattern.match(text, at)):
                free = m.end()
                if valid(m):
                    spans.append((at, free, kind))
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with a mark in place of every secret; overlapping ones share the first one's mark."""
    out, at = [], 0
    for start, end, kind in spans:
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def scan_secrets(docs: DataFrame) -> DataFrame:
    """Adds ``secrets``, an array of (start, end, kind) in code points, and ``redacted``.

    A NULL text has no secrets and stays NULL in ``redacted``. Columns of these names are replaced,
    all others pass through; repeated rows are scanned alike and an empty table gives no rows.
    """
    secret = T.StructType([
        T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
        T.StructField("kind", T.StringType()),
    ])
    fields = [T.StructField("secrets", T.ArrayType(secret)), T.StructField("redacted", T.StringType())]

    def start():
        finder = keyword_automaton()

        def work(texts):
            rows = []
            for text in texts:
                spans = find(text, finder) if text else []
                rows.append((spans, redact(text, spans) if spans else text))
            return rows

        return work

    return map_texts(docs, start, fields)


def spelled(secrets: str, kinds: tuple[str, ...] = KINDS):
    """The spans of ``kinds`` as kind:start:end, comma-joined in their order."""
    chosen = F.filter(secrets, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(
            chosen,
            lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def count_kind(secrets: str, kind: str):
    return F.size(F.filter(secrets, lambda s: s["kind"] == kind)).cast("long")
