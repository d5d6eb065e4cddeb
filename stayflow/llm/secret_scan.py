"""Secrets in texts: fixed shapes, and strings that compress badly where a secret is expected."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import zstandard
from pyspark.sql import DataFrame

from stayflow.llm.rows import add_columns

# Fixed shapes; letters of the first in either case. The number is the least length of the
# group that counts.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
# One of these is in every text the first shape matches; looking for them first is fast.
ASSIGN_STEMS = ("passw", "secret", "token", "api")
KINDS = ("assign", "access", "hex", "novel")

# Words near which an unexplained string is suspicious.
SENSITIVE = re.compile(
    r"secret|passw|pwd|token|api.?key|access.?key|private.?key|auth|bearer|credential|signature|client.?id",
    re.IGNORECASE | re.ASCII,
)
SENSITIVE_STEMS = "secret passw pwd token key auth bearer credential signature client".split()

# What code commonly says, so that identifiers and constants made of these parts compress.
IDENTIFIERS = """
abstract access account action address admin algorithm allow amazonaws api app application array assert
async authorization await backup base64 bearer bool boolean bucket buffer build byte cache callback cert
certificate channel char class client cloud cluster code collection column com commit component config
configuration connect connection const constructor container content context controller cookie count create
credentials current data database date default define delete deploy description dev development dict digest
directory disable document domain double download driver dump element email enable encoding encrypt endpoint
endpoints engine entity enum env environment error event example exception execute export expires extends
factory false field file filter final finally float folder format from function gateway generate get github
google group handler hash header headers host hostname html http https identifier import include index info
init input insert instance int integer interface internal item java json jdbc key label lambda length level
library limit list listener load local localhost location log logger login long main manager map master
message metadata method model module mongodb mysql name namespace native network new node null number object
option options order org output package page parameter params parent parse passwd password path payload
platform pointer policy port postgres prefix primary print private process product production profile project
property protected protocol provider proxy public python query queue random range read record redis ref
region register release remote repository request require response result return role root route row rsa
schema secret section security select self server service session set sha256 signature size socket source
spark sql ssh ssl stack start state static status storage stream string struct sub suffix super switch
system table tag target task template test text thread time timeout timestamp title token tools total true
type undefined unit update upload uri url user username users utf-8 uuid val value var vector version view
virtual void web window worker write www xml yaml zone
placeholder changeme your_api_key_here your-secret-token xxxxxxxxxxxxxxxx 0123456789 1234567890
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ
""".strip()


@dataclass(frozen=True)
class Novelty:
    """Which strings are judged and when one is reported.

    ``shortest``: characters of a candidate. ``context``: characters on either side of it in
    which a sensitive word must stand, unless it holds one itself. ``around``: characters on
    either side that prime the compressor together with the identifiers. ``least_ratio``:
    marginal compressed bytes per character from which it is reported.
    """

    shortest: int = 16
    context: int = 400
    around: int = 400
    least_ratio: float = 0.62
    identifiers: str = IDENTIFIERS


class Scanner:
    def __init__(self, novelty: Novelty) -> None:
        self.novelty = novelty
        self.candidate = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % novelty.shortest)
        self.near = SENSITIVE
        prime = zstandard.ZstdCompressionDict(
            novelty.identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        prime.precompute_compress(level=9)
        params = dict(write_checksum=False, write_content_size=False, write_dict_id=False)
        self.compressed = zstandard.ZstdCompressor(level=9, dict_data=prime, **params).compress

    def base(self, text: str, lower: str) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the fixed shapes, leftmost and non-overlapping per kind."""
        found = []
        if any(stem in lower for stem in ASSIGN_STEMS):
            for m in ASSIGN.finditer(text):
                if m.end(2) - m.start(2) >= LEAST_ASSIGN:
                    found.append((m.start(), 0, m.end()))
        if "AKIA" in text:
            for m in ACCESS.finditer(text):
                if m.end() - m.start() >= LEAST_ACCESS:
                    found.append((m.start(), 1, m.end()))
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        return sorted(found)

    def marginal(self, text: str, start: int, end: int) -> int:
        """Compressed bytes the string adds to its surroundings and the identifiers."""
        around = self.novelty.around
        before, after = text[max(0, start - around) : start], text[end : end + around]
        known = (before + after).encode()
        return len(self.compressed(known + text[start:end].encode())) - len(self.compressed(known))

    def novel(self, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """(start, kind, end) of further strings near a sensitive word that are hardly
        compressible. Candidates, sensitive words and base spans are walked through once, side
        by side, so the time grows with the length of the text."""
        words = [m.span() for m in self.near.finditer(text)]
        if not words:
            return []
        found, w, context = [], 0, self.novelty.context
        taken, t, covered_to = sorted((a, b) for a, _, b in base), 0, 0
        for m in self.candidate.finditer(text):
            start, end = m.span()
            while w < len(words) and words[w][1] < start - context:
                w += 1
            if w == len(words):
                break
            while t < len(taken) and taken[t][0] < end:
                covered_to = max(covered_to, taken[t][1])
                t += 1
            if words[w][0] > end + context or covered_to > start:
                continue
            if self.marginal(text, start, end) >= self.novelty.least_ratio * (end - start):
                found.append((start, 3, end))
        return found

    def scan(self, text: str) -> list[tuple[str, int, int]]:
        lower = text.lower()
        found = self.base(text, lower)
        if any(stem in lower for stem in SENSITIVE_STEMS):
            found = sorted(found + self.novel(text, found))
        return [(KINDS[k], a, b) for a, k, b in found]


@lru_cache(maxsize=4)
def scanner(novelty: Novelty) -> Scanner:
    return Scanner(novelty)


def find_secrets(
    df: DataFrame, text: str = "text", out: str = "secrets", novelty: Novelty = Novelty()
) -> DataFrame:
    """Add ``out``: array of (kind, start, end), ordered by start, then kind as in ``KINDS``.

    Positions are code points, the end exclusive. "assign", "access" and "hex" have fixed
    shapes. "novel" strings stand near a sensitive word, on either side of it, overlap no fixed
    shape and add nearly as many bytes as they are long to a zstandard frame primed with the
    surrounding text and common identifiers; ordinary identifiers, words, paths and repeats
    of what stands around add few. Null and empty texts have none; repeated rows are scanned each
    for itself; a column called ``out`` is replaced. The time for a text grows with its length. No shuffle.
    """

    def make():
        scan = scanner(novelty).scan
        return lambda value: (
            [{"kind": k, "start": a, "end": b} for k, a, b in scan(value)] if value else [],
        )

    return add_columns(df, text, f"`{out}` array<struct<kind:string,start:bigint,end:bigint>>", make)
