"""Personal data in text: fixed patterns, and a skip-chain conditional random field that goes on from them.

Tokens that hold digits, an at sign or a word for one are nodes with five labels
(none, e-mail, address, card, phone). Neighbours share a potential, and so do
distant tokens of a document that repeat or resemble each other; loopy message
passing brings their labels into line. What the patterns find is observed. The
weights are learnt from a bounded sample of the corpus: the patterns' finds, the
same finds written in other ways, and numbers that are nothing of the kind.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.common import fresh, map_texts

KINDS = ("email", "ip", "card", "phone")

# The base patterns, spelt so that no text takes more than linear time, and the digits they ask for.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS = (16, 19), (8, 15)

#: Documents and windows of a document that the weights are learnt from, at most, and the characters around a token.
SAMPLE, WINDOWS, AROUND = 3000, 12, 48
#: Rounds of message passing, the share of the old message in a new one, and the log-odds of an observed label.
PASSES, DAMPING, OBSERVED = 12, 0.3, 12.0
#: How sure a label must be to become a span.
SURE = 0.9
#: Fewest digits of a span, by kind; an e-mail needs an at sign instead.
DIGITS = (0, 4, 13, 7)

HIT = re.compile(r"[0-9@]|[(\[]at[)\]]", re.I)
AT = re.compile(r"[(\[]at[)\]]", re.I)
SPACE = re.compile(r"\s")
PIECE = re.compile(r"[\w.%+@()\[\]-]+")
GAP = re.compile(r"[\x20\t().-]{0,3}")
BEFORE, AFTER = re.compile(r"([^\W\d_]+)\W*$"), re.compile(r"\W*([^\W\d_]+)")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def small_parts(address: str) -> bool:
    """Whether every part is at most 255; leading zeros do not matter."""
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in (q.lstrip("0") for q in address.split(".")))


def emails(text: str) -> list[tuple[int, int]]:
    found, free, behind = [], 0, -1
    at = text.find("@")
    while at >= 0:
        # The local part goes back to the last at sign, the last match, or another character.
        low = max(free, behind + 1)
        start = low + len(text[low:at].rstrip(LOCAL))
        if start < at and (m := DOMAIN.match(text, at + 1)):
            found.append((start, m.end()))
            free = m.end()
        behind = at
        at = text.find("@", max(at + 1, free))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind number, start, end)`` of the base patterns, in code points."""
    spans = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    spans += [(1, *m.span()) for m in IP.finditer(text) if small_parts(m[0])]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= CARD_DIGITS[0]:
            digits = only_digits(m[0])
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                spans.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if PHONE_DIGITS[0] <= len(only_digits(m[0])) <= PHONE_DIGITS[1]:
                spans.append((3, *m.span()))
    return spans


@dataclass(slots=True)
class Token:
    start: int
    end: int
    text: str


def tokens(text: str) -> list[Token]:
    """Pieces of words with a digit or an at sign, and the pieces beside a word for one."""
    found: list[Token] = []
    place = 0
    while hit := HIT.search(text, place):
        # The whole word around the hit, and for "(at)" its neighbours too.
        start = hit.start()
        while start > place and not text[start - 1].isspace():
            start -= 1
        space = SPACE.search(text, hit.start())
        end = space.start() if space else len(text)
        if AT.fullmatch(text, start, end):
            back = start - 1
            while back > place and not text[back - 1].isspace():
                back -= 1
            start = max(place, back)
            word = re.compile(r"\s?\S*").match(text, end)
            end = word.end()
        for m in PIECE.finditer(text, start, end):
            piece = m[0].strip(".-%")
            if piece:
                at = m.start() + m[0].index(piece)
                found.append(Token(at, at + len(piece), piece))
        place = max(end, hit.end())
    return found


def shape(text: str) -> str:
    """Digits as 9, runs of letters as one a; only so much of it."""
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"\d", "9", text[:64]))[:28]


def features(text: str, token: Token) -> list[str]:
    own = token.text
    digits = only_digits(own)
    before = BEFORE.search(text[max(0, token.start - 24) : token.start])
    after = AFTER.match(text, token.end, token.end + 24)
    left = text[token.start - 1] if token.start else ""
    right = text[token.end] if token.end < len(text) else ""
    parts = own.split(".")
    dotted = len(parts) == 4 and all(p.isdecimal() and p.isascii() for p in parts)
    local, _, domain = own.partition("@")
    near_at = [bool(AT.search(text, max(0, token.start - 6), token.start)), bool(AT.search(text, token.end, token.end + 6))]
    return [
        "",
        f"shape {shape(own)}",
        f"digits {min(len(digits), 20)}",
        "marks " + "".join(sorted(set(own) & set("@.+()-%_"))),
        f"check {len(digits)} {luhn(digits)}" if 12 <= len(digits) <= 19 else "check",
        f"dotted {dotted and small_parts(own)}" if dotted else "dotted",
        f"before {before[1].lower() if before else ''}",
        f"after {after[1].lower() if after else ''}",
        f"beside {left if not left.isspace() else ''}|{right if not right.isspace() else ''}",
        f"at {'@' in own} {bool(local)} {'.' in domain} {bool(AT.fullmatch(own))} {near_at}",
        f"letters {any(c.isalpha() for c in own)} {len(digits) > 6}",
    ]


def keys(token: Token) -> list[str]:
    """What makes two tokens alike: the text, the last digits, the name before an at sign."""
    digits = only_digits(token.text)
    found = [f"t {token.text.casefold()}"] if len(token.text) >= 4 else []
    found += [f"d {digits[-7:]}"] if len(digits) >= 7 else []
    local = token.text.split("@")[0]
    return found + ([f"t {local.casefold()}"] if "@" in token.text and len(local) >= 4 else [])


def links(text: str, found: list[Token], offset: int = 0) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Edges between neighbours, and between each token and the last and the first one like it."""
    chain = [
        (offset + i, offset + i + 1)
        for i, (a, b) in enumerate(zip(found, found[1:], strict=False))
        if GAP.fullmatch(text, a.end, b.start)
    ]
    skip: set[tuple[int, int]] = set()
    last: dict[str, tuple[int, int]] = {}
    for i, token in enumerate(found):
        for key in keys(token):
            first, previous = last.get(key, (i, i))
            skip |= {(offset + j, offset + i) for j in (first, previous) if j < i}
            last[key] = (first, i)
    return chain, sorted(skip - set(chain))


def observed(found: list[Token], base: list[tuple[int, int, int]]) -> list[int]:
    """Each token's label by the longest base span that it touches, 0 for none; spans may overlap."""
    labels, lengths = [0] * len(found), [0] * len(found)
    starts = [t.start for t in found]
    for kind, a, b in base:
        i = max(0, int(np.searchsorted(starts, a, "right")) - 1)
        while i < len(found) and found[i].start < b:
            if found[i].end > a and b - a > lengths[i]:
                labels[i], lengths[i] = kind + 1, b - a
            i += 1
    return labels


LABELS = len(KINDS) + 1


@dataclass
class Model:
    """Weights of features (row 0: unknown ones) by label, and potentials of neighbours and of alike tokens."""

    rows: dict[str, int]
    weights: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def unary(self, named: list[list[str]]) -> np.ndarray:
        if not named:
            return np.zeros((0, LABELS))
        return self.weights[np.array([[self.rows.get(f, 0) for f in fs] for fs in named])].sum(1)


def marginals(unary: np.ndarray, chain: list, skip: list, model: Model) -> np.ndarray:
    """Label probabilities by loopy message passing, all messages at once, a few rounds."""
    edges = np.array([*chain, *skip], np.int64).reshape(-1, 2)
    count = len(edges)
    tables = np.stack([model.chain, model.skip, model.chain.T, model.skip.T])
    kind = np.r_[np.zeros(len(chain), int), np.ones(len(skip), int)]
    kind = np.r_[kind, kind + 2]
    source, target = np.r_[edges[:, 0], edges[:, 1]], np.r_[edges[:, 1], edges[:, 0]]
    back = np.r_[np.arange(count) + count, np.arange(count)]
    messages = np.zeros((2 * count, LABELS))
    belief = unary.copy()
    for _ in range(PASSES if count else 0):
        new = np.empty_like(messages)
        for a in range(0, 2 * count, 50_000):
            part = slice(a, a + 50_000)
            sent = belief[source[part]] - messages[back[part]]
            new[part] = np.logaddexp.reduce(sent[:, :, None] + tables[kind[part]], axis=1)
        new -= new.max(1, keepdims=True)
        messages = DAMPING * messages + (1 - DAMPING) * new
        belief = unary.copy()
        np.add.at(belief, target, messages)
    belief -= belief.max(1, keepdims=True)
    odds = np.exp(belief)
    return odds / odds.sum(1, keepdims=True)


def goes_on(text: str, token: Token, following: Token) -> bool:
    """Whether a span may run on; a plus sign begins a new one."""
    return following.text[0] != "+" and GAP.fullmatch(text, token.end, following.start) is not None


def field_spans(
    text: str, found: list[Token], shares: np.ndarray, base: list[tuple[int, int, int]]
) -> list[tuple[int, int, int]]:
    """Runs of neighbouring tokens that are surely of one kind and that no base span covers."""
    label = np.where(shares.max(1, initial=0) >= SURE, shares.argmax(1), 0).tolist() if len(found) else []
    spans, i = [], 0
    while i < len(found):
        j = i
        while j + 1 < len(found) and label[j + 1] == label[i] and goes_on(text, found[j], found[j + 1]):
            j += 1
        if label[i]:
            kind, a, b = label[i] - 1, found[i].start, found[j].end
            inside = text[a:b]
            enough = len(only_digits(inside)) >= DIGITS[kind] and (kind != 1 or inside.count(".") >= 3)
            if enough and not any(k == kind and s <= a and b <= e for k, s, e in base):
                spans.append((kind, a, b))
        i = j + 1
    return spans


def windows(text: str) -> list[str]:
    """Pieces of text around tokens, cut at white space, for learning."""
    out: list[str] = []
    end = -1
    for token in tokens(text):
        if token.start < end:
            continue
        a, b = max(0, token.start - AROUND), min(len(text), token.end + 2 * AROUND)
        out.append(text[a:b].partition(" ")[2] if a else text[a:b])
        end = b
        if len(out) == WINDOWS:
            break
    return out


def retold(kind: int, found: str, rng: random.Random) -> str:
    """As ``rewritten``, or as bare digits, which only their likeness to the first find tells from other numbers."""
    digits = only_digits(found)
    if kind > 1 and rng.random() < 0.5:
        return rng.choice([digits, digits[-10:]]) if kind == 3 else digits
    return rewritten(kind, found, rng)


def rewritten(kind: int, found: str, rng: random.Random) -> str:
    """The same thing in another way of writing."""
    digits = only_digits(found)
    if kind == 0:
        local, _, domain = found.partition("@")
        return rng.choice([f"{local} (at) {domain}", f"{local}[at]{domain}", f"{local} [at] {domain}", f"é{found}"])
    if kind == 1:
        return rng.choice([found, f"({found})", f"{found};"])
    if kind == 2:
        four = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        return rng.choice([" ".join(four), "-".join(four), ".".join(four), digits])
    rest, last = digits[-10:-7], digits[-7:]
    return rng.choice(
        [f"({rest}) {last[:3]}-{last[3:]}", f"{rest}-{last[:3]}-{last[3:]}", f"{rest}.{last[:3]}.{last[3:]}",
         f"00{digits[:-7]} {last}", f"{rest} {last[:3]} {last[3:]}"]
    )


def plain_number(kind: int, found: str, rng: random.Random) -> str:
    """A number that is no personal data: of as many digits as the find, or a date, time, amount, version or identifier."""
    n = rng.randrange
    if kind > 1 and rng.random() < 0.5:
        size = len(only_digits(found))
        size = rng.choice([size, size - 1, 10]) if kind == 3 else size
        return str(n(10 ** (size - 1), 10**size))
    return rng.choice(
        [" ".join(f"{n(10000):04}" for _ in range(n(1, 6))), f"{n(1900, 2100)}-{n(1, 13):02}-{n(1, 29):02}", f"{n(1, 29)}.{n(1, 13)}.{n(1900, 2100)}", f"{n(24):02}:{n(60):02}",
         f"{n(1000)},{n(1000):03}.{n(100):02}", f"{n(1000)}.{n(100):02}", str(n(10 ** n(1, 13))), f"v{n(20)}.{n(20)}.{n(20)}",
         f"{n(1900, 2100)}-{n(1900, 2100)}", f"{n(100)}%", f"({n(2100)})", f"{n(10**6)}-{n(10**4)}", f"{n(16**12):x}",
         f"#{n(10**5)}", f"{n(100)}x{n(100)}", f"{n(10)}-{n(10**5):05}-{n(10**3):03}-{n(10)}", f"({n(100)}) {n(1000)}"]
    )


def lessons(samples: list[list[str]]) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Texts with all their spans: as found, beside the same finds rewritten, and with plain numbers for them."""
    rng = random.Random(12)
    out = []
    for pieces in samples:
        text = "\n".join(pieces)
        base = base_spans(text)
        out.append((text, base))
        taken, end = [], 0
        for kind, a, b in sorted(base, key=lambda s: s[1:]):
            if a >= end:
                taken.append((kind, a, b))
                end = b
        for way in ("beside", "alone", "plain"):
            new, spans, length, place = [], [], 0, 0
            for kind, a, b in taken:
                make = plain_number if way == "plain" else rewritten if way == "alone" else retold
                word = make(kind, text[a:b], rng)
                new += [text[place:a], word]
                length += a - place + len(word)
                spans.append((kind, length - len(word), length))
                place = b
            changed = "".join([*new, text[place:]])
            if way == "plain":
                spans = base_spans(changed)
            if way == "alone":
                out.append((changed, spans))
            else:
                # Beside the original: what is alike is linked, what is not must stand by itself.
                shift = len(text) + 1
                out.append((f"{text}\n{changed}", base + [(k, a + shift, b + shift) for k, a, b in spans]))
    return out


def fitted(samples: list[list[str]], steps: int = 150, decay: float = 1e-3) -> Model:
    """Weights by pseudo-likelihood: each token's label given its features and its neighbours' labels."""
    named, labels, chain, skip = [], [], [], []
    for text, spans in lessons(samples):
        found = tokens(text)
        c, s = links(text, found, len(labels))
        chain, skip = chain + c, skip + s
        named += [features(text, t) for t in found]
        labels += observed(found, spans)
    seen = Counter(f for fs in named for f in fs)
    rows = {f: i for i, f in enumerate(sorted(f for f, n in seen.items() if n >= 3), 1)}
    model = Model(rows, np.zeros((len(rows) + 1, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((LABELS, LABELS)))
    if not labels:
        return model
    at = np.array([[rows.get(f, 0) for f in fs] for fs in named], np.int64)
    y = np.array(labels)
    truth = np.eye(LABELS)[y]
    chained, skipped = np.array(chain, np.int64).reshape(-1, 2), np.array(skip, np.int64).reshape(-1, 2)

    def neighbours(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of labels before and after each token, by edges."""
        before, after = np.zeros_like(truth), np.zeros_like(truth)
        np.add.at(before, pairs[:, 1], truth[pairs[:, 0]])
        np.add.at(after, pairs[:, 0], truth[pairs[:, 1]])
        return before, after

    around, alike = neighbours(chained), neighbours(skipped)
    parts = [model.weights, model.chain, model.skip]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parts]
    # A token has many features and few neighbours: their tables take larger steps to keep up.
    paces = (0.1, 0.2, 0.2)
    for step in range(1, steps + 1):
        logits = model.weights[at].sum(1)
        for (before, after), table in ((around, model.chain), (alike, model.skip)):
            logits += before @ table + after @ table.T
        logits -= logits.max(1, keepdims=True)
        odds = np.exp(logits)
        wrong = (odds / odds.sum(1, keepdims=True) - truth) / len(y)
        slope = np.stack(
            [np.bincount(at.ravel(), np.repeat(wrong[:, k], at.shape[1]), len(rows) + 1) for k in range(LABELS)], 1
        )
        slopes = [slope, *(b.T @ wrong + (a.T @ wrong).T for b, a in (around, alike))]
        # Likeness has no direction: which of two comes first says nothing.
        slopes[2] = slopes[2] + slopes[2].T
        for p, (m, v), g, pace in zip(parts, moments, slopes, paces, strict=True):
            g = g + decay * p / len(y)
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
        model.weights[0] = 0
    return model


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for kind, a, b in spans)


def learnt(docs: DataFrame, text: str = "text", sample: int = SAMPLE) -> Model:
    """The model for a corpus, from at most ``sample`` documents with tokens, chosen by a hash, and windows of them."""

    def make():
        return lambda texts: {"pieces": [windows(t or "") for t in texts]}

    column = F.col(f"`{text}`")
    open_ = docs.filter(column.rlike("[0-9@]")).select(column.alias("text"))
    # About twice as many texts as are wanted have a hash this low; their copies count once. So what any task sends,
    # and what the driver gets, does not grow with the corpus.
    space = 1 << 53
    low = min(space, 2 * sample * space // max(1, open_.count()))
    few = open_.filter(F.pmod(F.xxhash64("text"), F.lit(space)) < low).distinct()
    found = map_texts(few, [], [F.col("text")], "pieces array<string>", make)
    order = F.xxhash64("pieces")
    chosen = found.filter("size(pieces) > 0").distinct().orderBy(order, "pieces").limit(sample).collect()
    return fitted([list(r.pieces) for r in chosen])


def with_spans(docs: DataFrame, keep: list[str], names: list[str], text: str = "text") -> DataFrame:
    """The ``keep`` columns and, under ``names``: counts of four kinds, digest, spans, masked text or null."""
    shared = docs.sparkSession.sparkContext.broadcast(learnt(docs, text))

    def make():
        model = shared.value

        def each(texts: list[str | None]) -> dict[str, list]:
            texts = [t or "" for t in texts]
            bases = [base_spans(t) if HIT.search(t) else [] for t in texts]
            found = [tokens(t) if HIT.search(t) else [] for t in texts]
            named, chain, skip, ends, seen = [], [], [], [0], []
            for t, own, base in zip(texts, found, bases, strict=True):
                c, s = links(t, own, ends[-1])
                chain += c
                skip += s
                named += [features(t, token) for token in own]
                seen += observed(own, base)
                ends.append(ends[-1] + len(own))
            unary = model.unary(named)
            labels = np.array(seen, np.int64)
            unary[labels > 0, labels[labels > 0]] += OBSERVED
            shares = marginals(unary, chain, skip, model)
            rows = []
            for i, t in enumerate(texts):
                more = field_spans(t, found[i], shares[ends[i] : ends[i + 1]], bases[i])
                spans = sorted(bases[i] + more)
                kinds = [k for k, _, _ in bases[i]]
                digest = hashlib.sha256(joined(sorted(bases[i])).encode()).hexdigest()
                rows.append((*(kinds.count(k) for k in range(4)), digest, joined(spans), masked(t, spans) if spans else None))
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            return {n: list(c) for n, c in zip(names, columns, strict=True)}

        return each

    kinds = ["long"] * 4 + ["string"] * 3
    extra = ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds, strict=True))
    return map_texts(docs, keep, [F.col(f"`{text}`")], extra, make)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span, or run of overlapping spans, replaced by its kind in brackets."""
    out, place = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= place:
            out += [text[place:start], f"[{KINDS[kind]}]"]
        place = max(place, end)
    return "".join([*out, text[place:]])


def scanned(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document: the key, ``n_email, n_ip, n_card, n_phone, base_sha256, spans``.

    A null text counts as empty and has no spans; repeated rows come back as
    often as they came in; texts of any length are scanned whole, in linear
    time; further columns are ignored; an empty table gives an empty table.
    """
    names = ["n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "masked"]
    rows = docs.select(F.col(f"`{key}`").alias(key), F.col(f"`{text}`").alias(text))
    own = fresh(rows, *names)
    found = with_spans(rows, [key], own, text)
    return found.select(F.col(f"`{key}`"), *[F.col(f"`{o}`").alias(n) for o, n in zip(own[:6], names[:6], strict=True)])


def without_private(docs: DataFrame, text: str = "text", length: str = "n_chars") -> DataFrame:
    """All rows and columns of ``docs``, personal data in the text replaced by its kind and its length counted anew."""
    names = fresh(docs, "email", "ip", "card", "phone", "digest", "spans", "masked")
    found = with_spans(docs, docs.columns, names, text)
    clean = F.col(f"`{names[-1]}`")
    changed = {text: F.coalesce(clean, F.col(f"`{text}`"))}
    if length in docs.columns:
        kind = docs.schema[length].dataType
        changed[length] = F.when(clean.isNotNull(), F.length(clean)).otherwise(F.col(length)).cast(kind)
    return found.withColumns(changed).select(*[F.col(f"`{c}`") for c in docs.columns])
