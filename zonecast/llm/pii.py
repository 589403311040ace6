"""Personal data: base patterns plus spans found by a semi-Markov conditional random field.

A segmentation of a text is a sequence of entities and single outside symbols.
An entity's score comes from features of its whole span (group lengths, separators,
check sum, marks, neighbours); outside symbols score 0.  Entities are bounded in
length, so the sums over all segmentations (training) and the best segmentation
(decoding) are dynamic programs over the borders of candidate spans, which choose
borders and types jointly.  Candidates that overlap no other candidate are
independent, so a long text falls into many short programs.

The field is trained here, on the driver, from a bounded sample: windows of the
corpus around numbers and at-signs, labelled by the base patterns, and the same
windows with the match rewritten in other spellings.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField

from .common import annotate, hash_sample, one_text_each, unwrapped
from .pii_base import KINDS, LOCAL, base_spans, joined, luhn

#: an entity has at most so many groups of digits or domain labels, and characters
MAX_GROUPS, MAX_CHARS = 8, 96
#: an added span needs this marginal probability
SURE = 0.9

_SEPARATOR = r"[ ().\-/_\[\]]"
_CHAIN = re.compile(rf"[0-9]+(?:{_SEPARATOR}{{1,4}}[0-9]+)*")
_DIGITS = re.compile("[0-9]+")
_AT = re.compile(r"@|[\[({<] ?at ?[\])}>]|(?<=\w) at (?=[\w-]{1,40} dot )", re.IGNORECASE)
_DOT = re.compile(r"\.| ?[\[({<] ?dot ?[\])}>] ?| dot ", re.IGNORECASE)
_LABEL = re.compile(r"[A-Za-z0-9-]{1,63}")
_LOCAL_END = re.compile(rf"[{LOCAL}]{{1,64}}\Z")


@dataclass
class Candidate:
    start: int
    end: int
    kind: str
    features: list[str] = field(default_factory=list)


class Scored(NamedTuple):
    """A candidate without its features."""

    start: int
    end: int
    kind: str
    score: float


def _side(c: str) -> str:
    """Class of the character beside a span."""
    if not c:
        return "edge"
    if c.isalpha():
        return "letter"
    if c.isdigit():
        return "digit"
    return "blank" if c.isspace() else c


def _numeric(text: str) -> Iterator[Candidate]:
    for chain in _CHAIN.finditer(text):
        groups = [m.span() for m in _DIGITS.finditer(text, *chain.span())]
        total = sum(z - a for a, z in groups)
        if total < 7 and len(groups) < 4:
            continue
        for i, (a, _) in enumerate(groups):
            digits = 0
            for j in range(i, min(len(groups), i + MAX_GROUPS)):
                digits += groups[j][1] - groups[j][0]
                z = groups[j][1]
                if digits > 19 or z - a > MAX_CHARS:
                    break
                kinds = []
                if j - i == 3:
                    kinds.append("ip")
                if 7 <= digits <= 15:
                    kinds.append("phone")
                if digits >= 12:
                    kinds.append("card")
                if not kinds:
                    continue
                starts = [a]
                if text[a - 1:a] in ("+", "("):
                    starts.append(a - 1)
                for s in starts:
                    shared = _numeric_features(text, s, z, groups[i:j + 1])
                    yield from (Candidate(s, z, k, [f"{k}|{x}" for x in shared]) for k in kinds)


def _numeric_features(text: str, start: int, end: int, groups: list[tuple[int, int]]) -> list[str]:
    lengths = "-".join(str(min(z - a, 9)) for a, z in groups)
    marks = [text[x[1]:y[0]] for x, y in zip(groups, groups[1:])]
    digits = "".join(text[a:z] for a, z in groups)
    kinds = "".join(sorted(set(marks))) or "none"
    opened = text[start] if not text[start].isdigit() else ""
    within = all(int(text[a:z]) <= 255 for a, z in groups if z - a <= 4) and all(z - a <= 3 for a, z in groups)
    check = luhn(digits) if 12 <= len(digits) <= 19 else None
    left, right = _side(text[start - 1:start] if start else ""), _side(text[end:end + 1])
    before = re.search(r"([^\W\d_]+)\W{0,3}\Z", text[max(0, start - 24):start])
    return [
        "bias", f"n={len(digits)}", f"groups={len(groups)}", f"lengths={lengths}", f"marks={kinds}",
        f"marks,groups={kinds},{len(groups)}", f"one mark={len(set(marks)) <= 1}", f"opened={opened}",
        f"opened,lengths={opened},{lengths}", f"check={check}", f"check,lengths={check},{lengths}",
        f"within,groups={within},{len(groups)}", f"within,marks={within},{kinds}",
        f"left={left}", f"right={right}", f"sides={left},{right}", f"word={before[1].lower() if before else ''}",
        # a span that leaves out a neighbouring group of digits
        f"cut={bool(re.match(r'[ .-]?[0-9]', text[end:end + 2]))}",
        f"cut before={bool(re.search(r'[0-9][ .-]?[+(]?$', text[max(0, start - 3):start]))}",
    ]


def _mail(text: str) -> Iterator[Candidate]:
    for at in _AT.finditer(text):
        left = text[max(0, at.start() - 66):at.start()]
        gap = len(left) - len(left.rstrip(" "))
        local = _LOCAL_END.search(left[:-gap] if gap == 1 else left) if gap <= 1 else None
        if local is None:
            continue
        start = at.start() - gap - len(local[0])
        z = at.end()
        z += text[z:z + 1] == " "
        m, labels, dots = _LABEL.match(text, z), 0, []
        while m and labels < MAX_GROUPS and m.end() - start <= MAX_CHARS:
            labels += 1
            if labels > 1:
                last = m[0]
                mark = "@" if at[0] == "@" else "at" if at[0][0] == " " else "bracket"
                dot = "+".join(sorted(set(dots)))
                side = _side(text[m.end():m.end() + 1])
                more = bool(_DOT.match(text, m.end()) and _LABEL.match(text, _DOT.match(text, m.end()).end()))
                shared = [
                    "bias", f"mark={mark}", f"dots={dot}", f"mark,dots={mark},{dot}", f"labels={min(labels, 5)}",
                    f"last={min(len(last), 6)},{last.isalpha()}", f"more={more}", f"right={side}",
                    f"gap={gap},{at[0] == '@' and text[at.end():at.end() + 1] == ' '}",
                    f"left={_side(text[start - 1:start] if start else '')}",
                    f"local={'digit' if any(map(str.isdigit, local[0])) else 'plain'},{min(len(local[0]), 3)}",
                ]
                yield Candidate(start, m.end(), "email", [f"email|{x}" for x in shared])
            d = _DOT.match(text, m.end())
            if not d:
                break
            dots.append("." if d[0] == "." else "dot" if d[0][0] == " " and d[0].strip().isalpha() else "bracket")
            m = _LABEL.match(text, d.end())


def generated(text: str) -> Iterator[Candidate]:
    """Candidates of a whole text, one at a time: numbers, then addresses."""
    if _DIGITS.search(text):
        yield from _numeric(text)
    if "@" in text or _AT.search(text):
        yield from _mail(text)


def candidates(text: str) -> list[Candidate]:
    return sorted(generated(text), key=lambda c: (c.start, c.end, c.kind))


def independent(found: list[Candidate]) -> list[list[Candidate]]:
    """Groups of candidates (sorted by start) that overlap directly or through others."""
    groups, reach = [], -1
    for c in found:
        if c.start >= reach:
            groups.append([])
        groups[-1].append(c)
        reach = max(reach, c.end)
    return groups


def _add(x: float, y: float) -> float:
    if x < y:
        x, y = y, x
    return x + math.log1p(math.exp(y - x))


class Lattice:
    """Segmentations of one group: a path over span borders of outside steps and entities."""

    def __init__(self, group: list[Candidate], scores: list[float]):
        borders = sorted({c.start for c in group} | {c.end for c in group})
        at = {b: k for k, b in enumerate(borders)}
        self.group, self.scores, self.size = group, scores, len(borders)
        self.arcs = [(at[c.start], at[c.end], s) for c, s in zip(group, scores)]
        self.into, self.out_of = defaultdict(list), defaultdict(list)
        for n, (a, z, s) in enumerate(self.arcs):
            self.into[z].append((a, s, n))
            self.out_of[a].append((z, s))

    def best(self) -> list[int]:
        """Candidates of the best path; a tie goes to the path without the entity."""
        value, back = [0.0] * self.size, [None] * self.size
        for k in range(1, self.size):
            value[k] = value[k - 1]
            for a, s, n in self.into[k]:
                if value[a] + s > value[k]:
                    value[k], back[k] = value[a] + s, (a, n)
        chosen, k = [], self.size - 1
        while k > 0:
            if back[k] is None:
                k -= 1
            else:
                k, n = back[k]
                chosen.append(n)
        return chosen[::-1]

    def marginals(self) -> list[float]:
        forward = [0.0] * self.size
        for k in range(1, self.size):
            forward[k] = forward[k - 1]
            for a, s, _ in self.into[k]:
                forward[k] = _add(forward[k], forward[a] + s)
        backward = [0.0] * self.size
        for k in range(self.size - 2, -1, -1):
            backward[k] = backward[k + 1]
            for z, s in self.out_of[k]:
                backward[k] = _add(backward[k], backward[z] + s)
        return [math.exp(min(0.0, forward[a] + s + backward[z] - forward[-1])) for a, z, s in self.arcs]


@dataclass
class Model:
    weights: dict[str, float]

    def score(self, c: Candidate) -> float:
        return sum(self.weights.get(f, 0.0) for f in c.features)

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """Entities of the best segmentation that are sure enough."""
        out = []
        # a candidate's features (some two kilobytes) go as soon as it is scored
        found = sorted((c.start, c.end, c.kind, self.score(c)) for c in generated(text))
        for group in independent([Scored(*f) for f in found]):
            lattice = Lattice(group, [c.score for c in group])
            chosen = lattice.best()
            if chosen:
                sure = lattice.marginals()
                out += [(group[n].kind, group[n].start, group[n].end) for n in chosen if sure[n] >= SURE]
        return out


def all_spans(text: str, model: Model) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans: every base one and those of the field that touch none."""
    base = base_spans(text)
    added, k = [], 0
    taken: list[list[int]] = []  # base spans, overlapping ones joined
    for a, z in sorted((a, z) for _, a, z in base):
        if taken and a < taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], z)
        else:
            taken.append([a, z])
    for kind, a, z in model.spans(text):  # in order, and apart from each other
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if k == len(taken) or z <= taken[k][0]:
            added.append((kind, a, z))
    return base, sorted(base + added, key=lambda s: (s[1], KINDS.index(s[0])))


# --- training --------------------------------------------------------------------

Example = tuple[str, list[tuple[str, int, int]]]


def fit(examples: list[Example], epochs: int = 12, rate: float = 0.5, ridge: float = 2e-3, seed: int = 0) -> Model:
    """Ascend the conditional log-likelihood of the gold segmentations (AdaGrad steps)."""
    prepared = []
    for text, gold in examples:
        wanted = set(gold)
        found = candidates(text)
        if wanted - {(c.kind, c.start, c.end) for c in found}:
            continue  # not a segmentation that the candidates can express
        for group in independent(found):
            prepared.append((group, [(c.kind, c.start, c.end) in wanted for c in group]))
    often = Counter(f for group, _ in prepared for c in group for f in set(c.features))
    for group, _ in prepared:
        for c in group:  # words seen a few times teach nothing
            c.features = [f for f in c.features if "|word=" not in f or often[f] >= 5]
    weights, squares = defaultdict(float), defaultdict(lambda: 1e-6)
    rng = random.Random(seed)
    for _ in range(epochs):
        rng.shuffle(prepared)
        for group, gold in prepared:
            scores = [sum(weights[f] for f in c.features) for c in group]
            gradient = defaultdict(float)
            for c, is_gold, p in zip(group, gold, Lattice(group, scores).marginals()):
                if abs(is_gold - p) > 1e-4:
                    for f in c.features:
                        gradient[f] += is_gold - p
            for f, g in gradient.items():
                g -= ridge * weights[f]
                squares[f] += g * g
                weights[f] += rate * g / math.sqrt(squares[f])
    return Model({f: round(w, 6) for f, w in weights.items() if w})


def rewritten(kind: str, match: str, rng: random.Random) -> str:
    """Another spelling of a base match, one that the base patterns do not cover."""
    if kind == "email":
        local, _, domain = match.partition("@")
        style = rng.randrange(5)
        at, dot = ((" at ", " dot "), ("(at)", "."), (" [at] ", " [dot] "), (" (at) ", "."), ("@", "(dot)"))[style]
        return f"{local}{at}{dot.join(domain.split('.'))}"
    digits = "".join(c for c in match if c.isdigit())
    if kind == "ip":
        return rng.choice(("[.]", "(.)", " . ")).join(match.split("."))
    if kind == "card":
        mark = rng.choice((".", "/", "_", "  ", " - "))
        return mark.join(digits[i:i + 4] for i in range(0, len(digits), 4))
    number = digits[-10:].rjust(10, "2")
    a, b, c = number[:3], number[3:6], number[6:]
    return rng.choice((f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"1 ({a}) {b}-{c}"))


def _harmless(rng: random.Random) -> str:
    """Numbers that are no personal data."""
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    return rng.choice((
        lambda: f"20{d(2)}-0{rng.randint(1, 9)}-1{d(1)}", lambda: f"{rng.randint(1, 28)}/{rng.randint(1, 12)}/19{d(2)}",
        lambda: f"20{d(2)}-0{rng.randint(1, 9)}-1{d(1)} 1{d(1)}:3{d(1)}:0{d(1)}", lambda: f"version {d(1)}.{d(1)}.{d(2)}",
        lambda: f"{d(1)}.{d(2)}.{d(3)}.{d(4)}", lambda: f"{rng.randint(300, 999)}.{d(3)}.{rng.randint(300, 999)}.{d(2)}",
        lambda: d(rng.choice((7, 8, 9, 10, 12, 14))), lambda: _failing(d(16)), lambda: _failing(d(15)),
        lambda: " ".join(d(rng.randint(1, 3)) for _ in range(rng.randint(4, 9))), lambda: f"{d(2)}.{d(4)}, -{d(2)}.{d(4)}",
        lambda: f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", lambda: f"{rng.randint(1900, 2000)}-{rng.randint(2001, 2024)}",
        lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice((16, 32, 40)))),
        lambda: f"{d(4)}-{d(4)}", lambda: f"{d(3)} {d(3)} {d(3)}", lambda: f"$ {d(1)}.{d(3)}.{d(3)}",
        lambda: f"look at the dot in part {d(1)}", lambda: f"chapter {d(1)}.{d(1)}.{d(1)}.{d(1)}",
    ))()


def _failing(digits: str) -> str:
    return digits if not luhn(digits) else digits[:-1] + str((int(digits[-1]) + 1) % 10)


def _valid_card(rng: random.Random) -> str:
    body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
    return next(body + c for c in "0123456789" if luhn(body + c))


def _sample_match(kind: str, rng: random.Random) -> str:
    if kind == "email":
        name = "".join(rng.choice("abcdefghijklmnoprstuvw") for _ in range(rng.randint(3, 8)))
        return f"{name}{rng.choice(('', '.', '_', '7', '42'))}{rng.choice('abcde')}@{rng.choice(('mail', 'post', 'box', 'my-site'))}{rng.choice(('', '3', '.example'))}.{rng.choice(('com', 'org', 'net', 'de', 'fr'))}"
    if kind == "ip":
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "card":
        return _valid_card(rng)
    return f"+{rng.randint(1, 99)} {rng.randint(200, 999)} {rng.randint(100, 999)} {rng.randint(1000, 9999)}"


def examples_from(windows: list[str], seed: int = 0, made: int = 250) -> list[Example]:
    """Corpus windows with the base spans as gold, respelled windows, and made-up cases in corpus words."""
    rng = random.Random(seed)
    words = sorted({w for t in windows for w in re.findall(r"[^\W\d_]+", t)}) or ["the", "and", "of", "in"]

    def fill():
        return " ".join(rng.choice(words) for _ in range(rng.randint(0, 4)))

    out: list[Example] = []
    for text in windows:
        base = [s for s in base_spans(text)]
        crossing = any(x is not y and x[1] < y[2] and y[1] < x[2] for x in base for y in base)
        if crossing:
            continue
        out.append((text, base))
        if len(base) == 1 and not candidates_beyond(text, base):
            kind, a, z = base[0]
            new = rewritten(kind, text[a:z], rng)
            changed = text[:a] + new + text[z:]
            if not base_spans(changed):
                out.append((changed, [(kind, a, a + len(new))]))
    for kind in KINDS:
        for _ in range(made):
            match = _sample_match(kind, rng)
            left, right = fill(), fill()
            for new in (match, rewritten(kind, match, rng)):
                head = f"{left} " if left else ""
                text = f"{head}{new}{rng.choice((' ', '. ', ', '))}{right}"
                span = (kind, len(head), len(head) + len(new))
                if new != match and base_spans(text):
                    continue
                out.append((text, [span]))
    for _ in range(4 * made):
        text = f"{fill()} {_harmless(rng)}{rng.choice((' ', '. ', ', '))}{fill()}"
        out.append((text, base_spans(text)))
    return out


def candidates_beyond(text: str, base: list[tuple[str, int, int]]) -> bool:
    """Whether numbers or at-signs stand outside the base spans."""
    return any(all(c.end <= a or z <= c.start for _, a, z in base) for c in candidates(text))


def windows_of(text: str, most: int = 3, around: int = 40) -> list[str]:
    """Up to ``most`` pieces of a text around its numbers and at-signs, cut at blanks."""
    out, free = [], 0
    for m in re.finditer(rf"{_CHAIN.pattern}|@", text):
        if m.start() < free or (m[0] != "@" and sum(map(str.isdigit, m[0])) < 7 and m[0].count(".") < 3):
            continue
        a, z = max(0, m.start() - around), min(len(text), m.end() + around)
        while a > 0 and not text[a - 1].isspace() and m.start() - a < 3 * around:
            a -= 1
        while z < len(text) and not text[z].isspace() and z - m.end() < 3 * around:
            z += 1
        if z - a <= 400:
            out.append(text[a:z])
        free = z
        if len(out) == most:
            break
    return out


def _window_lists():
    return lambda texts: {"windows": [windows_of((t or b"").decode()) for t in texts]}


def train(docs: DataFrame, *, sample_rows: int = 4000, windows: int = 800, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on windows of at most ``sample_rows`` documents, those of smallest hash of the id.

    That bound is the documented one; at most ``windows`` windows are used.  A
    corpus without numbers still gives a model from the made-up cases.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).cast("long").alias("id")).filter("id is not null").distinct()
    chosen = [r.id for r in hash_sample(ids, "id", sample_rows)]
    if chosen:
        # sample_rows ids: the broadcast side and the collected windows have that bound
        sample = F.broadcast(spark.createDataFrame([(i,) for i in sorted(chosen)], "id long"))
        texts = one_text_each(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(sample, "id"))
        found = annotate(texts, "text", _window_lists, [StructField("windows", ArrayType(StringType()))])
        rows = found.filter(F.size("windows") > 0).select("windows").collect()
        pool = sorted({w for r in rows for w in r.windows}, key=lambda w: hashlib.md5(w.encode()).digest())[:windows]
    else:
        pool = []
    return fit(examples_from(pool))


# --- applying --------------------------------------------------------------------

def _found(model: Model):
    def make():
        def compute(texts):
            out = defaultdict(list)
            for t in texts:
                base, spans = all_spans((t or b"").decode(), model)
                counts = Counter(kind for kind, _, _ in base)
                for kind in KINDS:
                    out[f"n_{kind}"].append(counts[kind])
                out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
                out["spans"].append(joined(spans))
            return out

        return compute

    return make


def find(docs: DataFrame, model: Model, *, text_col: str = "text") -> DataFrame:
    """``whole`` (the row of ``docs``), n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and the digest are of the base matches; ``spans`` has these and the
    field's, as kind:start:end in code points.  Null text is empty; a text
    without matches has counts 0 and empty spans.  Base matches of different
    kinds may overlap and all stay; an added span overlaps none of them.
    """
    fields = [*(StructField(f"n_{k}", LongType()) for k in KINDS), StructField("base_sha256", StringType()), StructField("spans", StringType())]
    return annotate(docs, text_col, _found(model), fields)


def masked_text(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span, overlapping ones joined, replaced by its (first) kind's mark."""
    out, at, k = [], 0, 0
    while k < len(spans):
        kind, a, z = spans[k]
        k += 1
        while k < len(spans) and spans[k][1] < z:
            z = max(z, spans[k][2])
            k += 1
        out += [text[at:a], f"<{kind.upper()}>"]
        at = z
    return "".join([*out, text[at:]])


def _masked(model: Model):
    def make():
        def compute(texts):
            new = []
            for t in texts:
                text = None if t is None else t.decode()
                new.append(text and masked_text(text, all_spans(text, model)[1]))
            return {"masked": new}

        return compute

    return make


def mask(docs: DataFrame, model: Model, *, text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced by marks such as <EMAIL>, and the length column renewed.

    All columns and rows stay; null text stays null.
    """
    found = annotate(docs, text_col, _masked(model), [StructField("masked", StringType())])
    changed = {text_col: F.col("masked")}
    if chars_col in docs.columns:
        changed[chars_col] = F.length("masked").cast(docs.schema[chars_col].dataType)
    return found.select(*(changed[c].alias(c) if c in changed else col for c, col in zip(docs.columns, unwrapped(docs))))
