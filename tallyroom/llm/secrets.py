"""Secrets in text: fixed patterns, and values in credential contexts that would be hard to guess.

What a value would cost to guess is the cheapest way to build it from words,
dates, repeats, keyboard walks and single characters, found by dynamic
programming. Words are as cheap as they are frequent in the whole corpus.
"""

from __future__ import annotations

import hashlib
import math
import re
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.common import fresh, map_texts, stored

# The base patterns and the least length of what they must find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
#: What a text must contain for ASSIGN to be worth a search.
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "api")

# Further words for a credential, and what may stand between one and its value, authorisation schemes too.
CONTEXT_WORD = re.compile(
    r"(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|"
    r"auth(?:orization)?|credentials?|bearer)",
    re.I | re.A,
)
CONTEXT = re.compile(
    CONTEXT_WORD.pattern + r"""["'`]?[\x20\t]*(?::|=>?)[\x20\t]*["'`]?(?:(?:bearer|basic|token)[\x20\t]+(?![:=])["'`]?)?"""
    r"""([^\s"'`<>,;]+)""",
    re.I | re.A,
)
CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "api", "access", "private", "auth", "credential", "bearer")

KINDS = ("assign", "access", "hex", "guess")

# Passwords that everybody tries first, as words of the first ranks.
COMMON = (
    "password passwd secret admin root user guest test login master letmein welcome dragon monkey shadow sunshine "
    "princess football baseball superman batman iloveyou trustno changeme default example sample dummy placeholder "
    "none null empty true false your here insert token value string"
).split()
# The rows of a keyboard; a key touches its neighbours in its row and those above and below.
ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
# Characters that stand for letters.
LEET = str.maketrans("4@8(30!1$5+7", "aabceoiisstt")
YEAR = r"(?:19|20)\d\d"
#: Ways to write a date: a year; parts in three orders, between equal separators or none.
DATES = tuple(
    re.compile(p, re.A)
    for p in (
        YEAR,
        rf"(?P<y>{YEAR})([-/._])(?P<m>\d\d?)\2(?P<d>\d\d?)(?!\d)",
        rf"(?P<d>\d\d?)([-/._])(?P<m>\d\d?)\2(?P<y>{YEAR})",
        r"(?P<d>\d\d?)([-/._])(?P<m>\d\d?)\2(?P<y>\d\d)",
        rf"(?P<y>{YEAR})(?P<m>\d\d)(?P<d>\d\d)",
        rf"(?P<d>\d\d)(?P<m>\d\d)(?P<y>{YEAR})",
        r"(?P<d>\d\d)(?P<m>\d\d)(?P<y>\d\d)",
    )
)

#: Guesses, as a power of ten, from which a value counts as a secret.
HARD = 10.0
#: A value under this length is no secret.
LEAST = 6
#: Powers of ten: a character by brute force, a date, and one more part.
BRUTE, DAY, PART = 1.0, math.log10(365 * 119), 0.5
#: The longest unit that counts as a repeat.
UNIT = 16
#: A word is known if it makes up this share of the words of all documents, each counted once a document, so at most
#: 50,000 words are; and if it is in several documents, lest the words of one make themselves cheap.
KNOWN_SHARE, KNOWN_DOCUMENTS = 1 / 50_000, 3


def neighbours() -> dict[str, str]:
    near: dict[str, set[str]] = {}
    for y, row in enumerate(ROWS):
        for x, key in enumerate(row):
            around = [(y, x - 1), (y, x + 1), (y - 1, x), (y - 1, x + 1), (y + 1, x - 1), (y + 1, x)]
            near[key] = {ROWS[b][a] for b, a in around if 0 <= b < len(ROWS) and 0 <= a < len(ROWS[b])}
    return {k: "".join(sorted(v)) for k, v in near.items()}


NEAR = neighbours()


def date_ends(value: str, start: int) -> set[int]:
    """Where the dates that begin at ``start`` end; day and month, in either order, must exist."""
    ends = set()
    for pattern in DATES:
        if m := pattern.match(value, start):
            parts = m.groupdict()
            first, second = sorted((int(parts.get("d", 1)), int(parts.get("m", 1))))
            if first >= 1 and first <= 12 and second <= 31:
                ends.add(m.end())
    return ends


def guess_cost(value: str, ranks: dict[str, int], longest: int) -> float:
    """The power of ten of the guesses that the cheapest segmentation of ``value`` takes.

    ``ranks`` gives words from 1, ``longest`` the length of the longest one.
    Time grows with the value's length, not its square.
    """
    n = len(value)
    low = value.lower()
    if len(low) != n:
        low = value
    plain = low.translate(LEET)
    # Where the same keyboard walk goes on, and its turns.
    walk = [0] * n
    for i in range(n - 2, -1, -1):
        walk[i] = walk[i + 1] + 1 if low[i + 1] in NEAR.get(low[i], "") else 0
    same = {u: [0] * (n + 1) for u in range(1, min(UNIT, n // 2) + 1)}
    for u, run in same.items():
        for i in range(n - u - 1, -1, -1):
            run[i] = run[i + 1] + 1 if value[i] == value[i + u] else 0
    dates = {i: date_ends(value, i) for i in range(n) if "0" <= value[i] <= "9"}

    infinite = math.inf
    best = [infinite] * (n + 1)  # value[:i], ending with any part
    brute = [infinite] * (n + 1)  # value[:i], ending with brute force
    best[0] = 0.0
    for i in range(n):
        # The cheapest way so far, before the parts that start here.
        best[i] = min(best[i], brute[i])
        here = best[i] + (PART if i else 0.0)

        def reach(end: int, cost: float, here: float = here) -> None:
            best[end] = min(best[end], here + cost)

        brute[i + 1] = min(brute[i + 1], min(here, brute[i]) + BRUTE)
        for end in range(i + 3, min(n, i + longest) + 1):
            for form, extra in ((low[i:end], 0.0), (plain[i:end], 0.3)):
                if form in ranks:
                    changed = value[i:end] != low[i:end]
                    reach(end, math.log10(ranks[form] + 1) + extra + 0.3 * changed)
                    break
        for end in dates.get(i, ()):
            reach(end, DAY if end - i > 4 else math.log10(119))
        if walk[i] >= 2:
            for end in (i + 3, i + walk[i] + 1):
                reach(end, math.log10(47) + 0.3 * (end - i))
        for u, run in same.items():
            if run[i] >= u and run[i] + u >= 3:
                times = run[i] // u + 1
                reach(i + u * times, BRUTE * u + math.log10(times))
    return min(best[n], brute[n])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base patterns, in code points, kinds as in ``KINDS``."""
    spans = []
    low = text.lower()
    if any(h in low for h in ASSIGN_HINTS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def guess_spans(
    text: str, base: list[tuple[int, int, int]], ranks: dict[str, int], longest: int
) -> list[tuple[int, int, int]]:
    """Values in a credential context that are hard to guess, and that no base span covers as a whole."""
    low = text.lower()
    if not any(h in low for h in CONTEXT_HINTS):
        return []
    found = []
    place = 0
    while m := CONTEXT.search(text, place):
        start, end = m.span(1)
        # A value that is a context word may have the value behind it.
        place = start if CONTEXT_WORD.fullmatch(m[1].rstrip(":=>")) else end
        if end - start < LEAST or any(a <= start and end <= b for a, _, b in base):
            continue
        if guess_cost(m[1], ranks, longest) >= HARD:
            found.append((start, 3, end))
    return found


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, or run of overlapping spans, replaced by a mark."""
    out, place = [], 0
    for start, _, end in spans:
        if start >= place:
            out += [text[place:start], "[secret]"]
        place = max(place, end)
    return "".join([*out, text[place:]]) if spans else text


def vocabulary(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """Ranks of the words in ``KNOWN_SHARE`` or more of all pairs of a word and a document.

    Their number is bounded by that share, whatever the corpus. Values in a
    credential context and access keys do not count: a secret must not make
    itself a known word, however often it is repeated.
    """
    plain = F.col(f"`{text}`")
    # Searched for only where there can be one: a context needs one of two signs.
    for pattern, signs in ((f"(?i){CONTEXT.pattern}", (":", "=")), (ACCESS.pattern, ("AKIA",))):
        sign = reduce(or_, [F.contains(F.col(f"`{text}`"), F.lit(s)) for s in signs])
        plain = F.when(sign, F.regexp_replace(plain, pattern, " ")).otherwise(plain)
    split = F.split(F.lower(plain), r"[^\p{L}]+")
    words = docs.select(F.explode(F.array_distinct(split)).alias("word"))
    counts = stored(
        words.groupBy("word").agg(F.count("*").alias("n")).filter("length(word) >= 3"), "words"
    )
    total = counts.agg(F.sum("n")).first()[0] or 0
    frequent = counts.filter(F.col("n") >= max(total * KNOWN_SHARE, KNOWN_DOCUMENTS))
    ordered = sorted(frequent.collect(), key=lambda r: (-r.n, r.word))
    ranks = {w: i for i, w in enumerate(COMMON, 1)}
    for i, row in enumerate(ordered, 1):
        ranks[row.word] = min(ranks.get(row.word, i), i)
    return ranks


def with_spans(docs: DataFrame, keep: list[str], names: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns and, under ``names``: counts of three kinds, digest, spans, redacted text or null."""
    ranks = vocabulary(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    longest = max(map(len, ranks))

    def make():
        known = shared.value

        def each(texts: list[str | None]) -> dict[str, list]:
            rows = []
            for t in texts:
                t = t or ""
                base = base_spans(t)
                spans = sorted(base + guess_spans(t, base, known, longest))
                kinds = [k for _, k, _ in base]
                digest = hashlib.sha256(joined(base).encode()).hexdigest()
                clean = redacted(t, spans) if spans else None
                rows.append((kinds.count(0), kinds.count(1), kinds.count(2), digest, joined(spans), clean))
            columns = zip(*rows, strict=True)
            return {n: list(c) for n, c in zip(names, columns, strict=True)}

        return each

    a, b, c, d, e, f = names
    extra = f"`{a}` long, `{b}` long, `{c}` long, `{d}` string, `{e}` string, `{f}` string"
    return map_texts(docs, keep, [F.col(f"`{text}`")], extra, make)


def scanned(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document: the key, ``n_assign, n_access, n_hex, base_sha256, spans``.

    A null text counts as empty and has no spans; repeated rows come back as
    often as they came in; an empty table gives an empty table.
    """
    names = ["_assign", "_access", "_hex", "_sha256", "_spans", "_redacted"]
    found = with_spans(docs, [key], names, text)
    return found.select(
        F.col(f"`{key}`"),
        F.col("_assign").alias("n_assign"),
        F.col("_access").alias("n_access"),
        F.col("_hex").alias("n_hex"),
        F.col("_sha256").alias("base_sha256"),
        F.col("_spans").alias("spans"),
    )


def without_secrets(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """All rows and columns of ``docs``, secrets in the text replaced by a mark and its length counted anew."""
    names = fresh(docs, "assign", "access", "hex", "sha256", "spans", "redacted")
    found = with_spans(docs, docs.columns, names, text)
    clean = F.col(names[-1])
    changed = {text: F.coalesce(clean, F.col(f"`{text}`"))}
    if length in docs.columns:
        kind = docs.schema[length].dataType
        changed[length] = F.when(clean.isNotNull(), F.length(clean)).otherwise(F.col(length)).cast(kind)
    return found.withColumns(changed).select(*[F.col(f"`{c}`") for c in docs.columns])
