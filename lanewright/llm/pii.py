"""Personal data: four fixed patterns, and a semi-Markov conditional random field for what they miss.

The field scores whole candidate spans (digit groups, separators, check digits, neighbours)
and chooses boundaries and types of a stretch of text together, by dynamic programming over
segments of at most ``MAX_TOKENS`` tokens. It is trained here, by gradient ascent on the
likelihood of segmentations: stretches of the given documents labelled by the fixed
patterns, copies of them in other notations (national phone numbers, spelled-out addresses),
and made-up look-alikes without personal data (dates, versions, amounts, codes).
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewright.llm.batches import pieces, strings
from lanewright.llm.spans import apart

#: Kinds in the order in which spans of equal start are listed.
KINDS = ("email", "ip", "card", "phone")
#: Longest entity of the field, in tokens.
MAX_TOKENS = 16
#: Documents with a digit or an @ that the field is trained on, those with the smallest hash of their text.
TRAINING_DOCS = 2000
EPOCHS = 6
#: A span is added if the field gives it at least this probability within its stretch.
MIN_PROBABILITY = 0.9

# fixed values: the base patterns (the e-mail pattern is applied around each @, in linear time)
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of local part, @ and dotted domain; looks at each @ once."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            done = domain.end()
            yield start, done, "email"
            at = text.find("@", done)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns; matches that fail their check are dropped, not tried again."""
    found = list(emails(text))
    if DIGIT.search(text):
        found += [(*m.span(), "ip") for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if 12 <= m.end() - m.start() <= 37 and 12 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                found.append((*m.span(), "card"))
        if "+" in text:
            found += [(*m.span(), "phone") for m in PHONE.finditer(text) if 9 <= len(digits_of(m[0])) <= 15]
    return found


DIGIT = re.compile(r"[0-9]")
TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s+|[^A-Za-z0-9\s]")
#: Stretches: chunks with a digit or an @, or spelled-out parts of an address, with at most a blank between them.
CHUNK = r"(?:[^\s@0-9]*+[@0-9]\S*+|\(?(?:at|dot)\)?|\[(?:at|dot)\])"
STRETCH = re.compile(rf"(?<!\S)(?:[A-Za-z][A-Za-z._-]*\x20(?=[(\[]?at[)\]]?\x20))?{CHUNK}(?:\x20(?:{CHUNK}|[A-Za-z-]+(?=\x20[(\[]?dot[)\]]?\x20)|(?<=dot\x20)[A-Za-z]{{2,6}}|(?<=dot\)\x20)[A-Za-z]{{2,6}}|(?<=dot\]\x20)[A-Za-z]{{2,6}})(?!\S))*")
WORTH = re.compile(r"[0-9](?:[^0-9\s]?[\x20]?[^0-9\s]?[0-9]){6}|@|\bdot\b")
#: Tokens of a part of a longer stretch, and tokens seen on either side of it, more than an entity has.
PART_TOKENS, AROUND_TOKENS = 100, 2 * MAX_TOKENS
SPELLED_AT, SPELLED_DOT = re.compile(r"\x20[(\[]?at[)\]]?\x20"), re.compile(r"\x20[(\[]?dot[)\]]?\x20")
HOST = re.compile(r"[@\x20.][A-Za-z0-9-]+(?:\.|\x20[(\[]?dot[)\]]?\x20)[A-Za-z]{2,6}$")
NAMES = {"email": "mail email contact write", "ip": "ip address host server", "card": "card visa credit account", "phone": "tel phone call fax mobile"}
CUES = {word: kind for kind, words in NAMES.items() for word in words.split()}
LABELS = (None, *KINDS)


def features(text: str, before: str, after: str, cue: str) -> list[str]:
    """What the field sees of a whole candidate span and its neighbours."""
    digits = digits_of(text)
    groups = re.findall(r"[0-9]+", text)
    letters = any(c.isalpha() for c in text)
    marks = "".join(sorted({c for c in text if not c.isalnum()}))
    at, dot = text.count("@"), len(SPELLED_DOT.findall(text))
    spelled = bool(SPELLED_AT.search(text))
    out = [
        "bias", f"digits={min(len(digits), 20)}", f"letters={letters}", f"marks={marks[:6]}", f"at={min(at, 2)}",
        f"first={'9' if text[0].isdigit() else 'a' if text[0].isalpha() else text[0]}",
        f"before={'9' if before.isdigit() else 'a' if before.isalpha() else before}",
        f"after={'9' if after.isdigit() else 'a' if after.isalpha() else after}",
    ]
    if not letters:
        out.append("groups=" + "-".join(str(len(g)) for g in groups[:6]))
        out.append(f"joined={marks[:6]}:{len(groups)}")
        if 12 <= len(digits) <= 19:
            out.append(f"luhn={luhn(digits)}")
        if len(groups) == 4 and marks == ".":
            out.append(f"octets={all(len(g) <= 3 and int(g) <= 255 for g in groups)}")
    else:
        out.append(f"spelled={spelled}:{min(dot, 1)}:{min(at, 2)}")
        out.append(f"blank={' ' in text}")
        out.append(f"host={bool(HOST.search(text))}")
    if cue:
        out.append(f"cue={cue}")
    return out


class Stretch:
    """Tokens of a stretch or a part of it, and its candidate segments (first token, end token, features)."""

    def __init__(self, text: str, start: int, end: int, whole: int | None = None):
        """``whole`` is where the whole stretch starts; the words before it are the cue."""
        self.marks = [m.span() for m in TOKEN.finditer(text, start, end)]
        whole = start if whole is None else whole
        words = re.findall(r"[a-z]+", text[max(0, whole - 24) : whole].lower())
        cue = next((CUES[w] for w in reversed(words[-2:]) if w in CUES), "")
        self.segments: list[tuple[int, int, list[str]]] = []
        for i, (a, first_end) in enumerate(self.marks):
            head = text[a]
            if not (head.isalnum() or head in "+(") or head == "(" and not text[a + 1 : a + 2].isdigit():
                continue
            for j in range(i, min(i + MAX_TOKENS, len(self.marks))):
                b = self.marks[j][1]
                if not text[b - 1].isalnum():
                    continue
                piece = text[a:b]
                if 7 <= sum(map(str.isdigit, piece)) <= 24 or "@" in piece or SPELLED_AT.search(piece) and SPELLED_DOT.search(piece):
                    if piece.isascii():
                        self.segments.append((i, j + 1, features(piece, text[a - 1 : a], text[b : b + 1], cue)))

    def gold(self, spans: list[Span]) -> list[tuple[int, int, int]] | None:
        """The given spans as (first token, end token, label); None if one is no candidate."""
        first, last = {a: i for i, (a, _) in enumerate(self.marks)}, {b: i + 1 for i, (_, b) in enumerate(self.marks)}
        known = {(i, j) for i, j, _ in self.segments}
        out = [(first.get(a, -1), last.get(b, -1), LABELS.index(kind)) for a, b, kind in spans]
        return out if all((i, j) in known for i, j, _ in out) else None


class Field:
    """Weights of features by label, and of neighbouring labels; label 0 is a token of no entity."""

    def __init__(self):
        self.names: dict[str, int] = {}
        self.weights = np.zeros((0, len(LABELS)))
        self.moves = np.zeros((len(LABELS), len(LABELS)))

    def number(self, names: list[str], grow: bool = False) -> np.ndarray:
        if grow:
            for n in names:
                self.names.setdefault(n, len(self.names))
        return np.array([self.names[n] for n in names if n in self.names], dtype=np.int64)

    def scores(self, stretch: Stretch, numbers: list[np.ndarray]) -> np.ndarray:
        out = np.array([self.weights[k].sum(axis=0) for k in numbers]).reshape(-1, len(LABELS))
        out[:, 0] = -np.inf
        return out

    def lattice(self, stretch: Stretch, numbers: list[np.ndarray]):
        """Log sums over all segmentations: from the left, from the right, and the segments' scores."""
        n, scores = len(stretch.marks), self.scores(stretch, numbers)
        into: list[list[int]] = [[] for _ in range(n + 1)]
        out_of: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (i, j, _) in enumerate(stretch.segments):
            into[j].append(k)
            out_of[i].append(k)
        alpha, beta = np.full((n + 1, len(LABELS)), -np.inf), np.full((n + 1, len(LABELS)), -np.inf)
        alpha[0, 0] = 0.0
        for j in range(1, n + 1):
            alpha[j, 0] = np.logaddexp.reduce(alpha[j - 1] + self.moves[:, 0])
            for k in into[j]:
                here = np.logaddexp.reduce(alpha[stretch.segments[k][0]][:, None] + self.moves, axis=0) + scores[k]
                alpha[j] = np.logaddexp(alpha[j], here)
        beta[n] = 0.0
        for i in range(n - 1, -1, -1):
            ways = [self.moves[:, 0] + beta[i + 1, 0]]
            for k in out_of[i]:
                ways.append(np.logaddexp.reduce(self.moves + (scores[k] + beta[stretch.segments[k][1]])[None, :], axis=1))
            beta[i] = np.logaddexp.reduce(np.array(ways), axis=0)
        return alpha, beta, scores

    def marginals(self, stretch: Stretch, numbers: list[np.ndarray]) -> np.ndarray:
        alpha, beta, scores = self.lattice(stretch, numbers)
        total = np.logaddexp.reduce(alpha[-1])
        out = np.zeros_like(scores)
        for k, (i, j, _) in enumerate(stretch.segments):
            enter = np.logaddexp.reduce(alpha[i][:, None] + self.moves, axis=0)
            out[k] = np.exp(enter + scores[k] + beta[j] - total)
        return out

    def best(self, stretch: Stretch) -> list[tuple[int, int, int]]:
        """The best segmentation's entities: (first token, end token, label)."""
        n, numbers = len(stretch.marks), [self.number(f) for _, _, f in stretch.segments]
        scores = self.scores(stretch, numbers)
        into: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (_, j, _) in enumerate(stretch.segments):
            into[j].append(k)
        value = np.full((n + 1, len(LABELS)), -np.inf)
        value[0, 0] = 0.0
        back: dict[tuple[int, int], tuple[int, int]] = {}
        for j in range(1, n + 1):
            ways = value[j - 1] + self.moves[:, 0]
            value[j, 0], back[j, 0] = ways.max(), (j - 1, int(ways.argmax()))
            for k in into[j]:
                i = stretch.segments[k][0]
                ways = value[i][:, None] + self.moves + scores[k][None, :]
                for y in range(1, len(LABELS)):
                    if (top := ways[:, y].max()) > value[j, y]:
                        value[j, y], back[j, y] = top, (i, int(ways[:, y].argmax()))
        out, j, y = [], n, int(value[n].argmax())
        while j > 0:
            i, previous = back[j, y]
            if y:
                out.append((i, j, y))
            j, y = i, previous
        return out[::-1]

    def train(self, examples: list[tuple[Stretch, list[tuple[int, int, int]]]], epochs: int = EPOCHS) -> None:
        """Gradient ascent on the log likelihood, with steps by Adagrad and a small pull to zero."""
        numbered = [([self.number(f, grow=True) for _, _, f in s.segments], s, gold) for s, gold in examples]
        self.weights = np.zeros((len(self.names), len(LABELS)))
        seen, seen_moves = np.full(self.weights.shape, 1e-2), np.full(self.moves.shape, 1e-2)
        order = random.Random(11)
        for _ in range(epochs):
            order.shuffle(numbered)
            for numbers, stretch, gold in numbered:
                if not stretch.segments:
                    continue
                expected = self.marginals(stretch, numbers)
                wanted = {(i, j): y for i, j, y in gold}
                for k, (i, j, _) in enumerate(stretch.segments):
                    step = -expected[k]
                    if (i, j) in wanted:
                        step[wanted[i, j]] += 1
                    if np.abs(step).max() > 1e-3:
                        rows = numbers[k]
                        seen[rows] += step**2
                        self.weights[rows] += 0.3 * (step / np.sqrt(seen[rows])) - 1e-4 * self.weights[rows]
                follow = np.zeros_like(self.moves)
                ends = {j: y for _, j, y in gold}
                for i, _, y in gold:
                    follow[ends.get(i, 0), y] += 1
                alpha, beta, scores = self.lattice(stretch, numbers)
                total = np.logaddexp.reduce(alpha[-1])
                for k, (i, j, _) in enumerate(stretch.segments):
                    follow -= np.exp(alpha[i][:, None] + self.moves + (scores[k] + beta[j])[None, :] - total)
                follow[:, 0] = 0
                seen_moves += follow**2
                self.moves += 0.1 * follow / np.sqrt(seen_moves)


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """Places where personal data may stand; found in linear time."""
    for m in STRETCH.finditer(text):
        if WORTH.search(m[0]):
            yield m.span()


def parts(text: str, start: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """Parts of a stretch that overlap: start, end, and from where to where the entities start that it decides.

    Parts end at token borders; each place of the stretch is decided by one part, which sees
    ``AROUND_TOKENS`` on either side, so that it holds each of its entities wholly.
    """
    marks = (m.span() for m in TOKEN.finditer(text, start, end))
    held, first = list(islice(marks, PART_TOKENS + AROUND_TOKENS)), 0
    while first < len(held):
        more = list(islice(marks, PART_TOKENS))
        last = first + PART_TOKENS if more else len(held)
        yield held[0][0], held[-1][1], held[first][0], held[last - 1][1]
        kept = max(0, last - AROUND_TOKENS)
        held, first = held[kept:] + more, last - kept


def variants(text: str, kind: str, rng: random.Random) -> list[str]:
    """The same datum in notations that the fixed patterns do not match."""
    if kind == "phone":
        d = digits_of(text)[-10:]
        return [f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"1-{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}"]
    if kind == "email":
        name, host = text.split("@", 1)
        spelled = host.replace(".", " dot ")
        return [f"{name} at {spelled}", f"{name} (at) {host.replace('.', ' (dot) ')}", f"{name} [at] {host.replace('.', ' [dot] ')}"]
    if kind == "card":
        d = digits_of(text)
        return [".".join(d[k : k + 4] for k in range(0, len(d), 4))]
    return []


def lookalikes(rng: random.Random) -> str:
    """Numbers that are nobody's data."""
    n = rng.randrange
    return rng.choice([
        f"{n(1990, 2030)}-{n(1, 13):02d}-{n(1, 29):02d} {n(24):02d}:{n(60):02d}:{n(60):02d}", f"{n(10**7, 10**9)}",
        f"{n(1, 30)}.{n(1, 20)}.{n(10**4, 10**6)}", f"{n(10**9, 10**15)}", f"{n(1, 999)},{n(1000):03d},{n(1000):03d}",
        f"{n(1, 13):02d}/{n(1, 29):02d}/{n(1990, 2030)}", f"{n(10**15, 10**16)}", f"{n(978, 980)}-{n(10)}-{n(100, 999)}-{n(10000, 99999)}-{n(10)}",
        f"{n(300, 999)}.{n(300, 999)}.{n(300, 999)}.{n(300, 999)}", f"{n(10**4, 10**5)}-{n(10**3, 10**4)}", f"0x{n(10**9, 10**12):x}",
        f"{n(1, 99)}.{n(10**7, 10**9)}", f"#{n(10**6, 10**8)}", f"{n(1000, 2000)} {n(1000, 2000)}", f"look at {n(10**6, 10**8)}",
    ])


def trained(texts: list[str]) -> Field:
    """A field trained on the stretches of some texts, their variants and look-alikes."""
    rng, examples = random.Random(7), []

    def add(text: str, spans: list[Span]) -> None:
        for whole, start, end in ((at, a, b) for at, to in stretches(text) for a, b, _, _ in parts(text, at, to)):
            if any(s[0] < start < s[1] or s[0] < end < s[1] for s in spans):  # a neighbouring part holds it wholly
                continue
            stretch = Stretch(text, start, end, whole)
            inside = [s for s in spans if start <= s[0] and s[1] <= end]
            chosen, at = [], 0
            for s in sorted(inside, key=lambda s: (s[0], -s[1])):  # of overlapping ones the longest from the left
                if s[0] >= at:
                    chosen.append(s)
                    at = s[1]
            gold = stretch.gold(chosen)
            if stretch.segments and gold is not None:
                examples.append((stretch, gold))

    samples = {"email": ["ann.lee@mail.example.com"], "ip": ["10.0.12.7"], "card": ["4111111111111111"], "phone": ["+1 (212) 555-0142"]}
    for text in texts:
        spans = base_spans(text)
        add(text, spans)
        for a, b, kind in spans:
            samples[kind].append(text[a:b])
    words = [w for t in texts for w in t.split() if w.isalpha()] or ["word"]
    for kind, found in samples.items():
        for one in (rng.choice(found) for _ in range(150)):
            for other in [one, *variants(one, kind, rng)]:
                left = rng.choice([*words, *NAMES[kind].split()])
                text = f"{rng.choice(words)} {left}{rng.choice(['', '', ':'])} {other}{rng.choice(['', '', '.', ','])} {rng.choice(words)}"
                start = text.index(other, len(left))
                add(text, [(start, start + len(other), kind)])
    for _ in range(900):
        add(f"{rng.choice(words)} {lookalikes(rng)} {rng.choice(words)}", [])
    field = Field()
    field.train(examples)
    return field


def field_spans(text: str, field: Field, min_probability: float = MIN_PROBABILITY) -> list[Span]:
    """Entities of the best segmentation of each stretch that are probable enough."""
    out: list[Span] = []
    for whole, to in stretches(text):
        before = None  # the last entity, and its probability; parts may disagree on overlapping ones
        for start, end, first, last in parts(text, whole, to):
            stretch = Stretch(text, start, end, whole)
            found = field.best(stretch) if stretch.segments else []
            if not found:
                continue
            sure = field.marginals(stretch, [field.number(f) for _, _, f in stretch.segments])
            at = {(i, j): k for k, (i, j, _) in enumerate(stretch.segments)}
            for i, j, y in found:
                span, p = (stretch.marks[i][0], stretch.marks[j - 1][1], LABELS[y]), sure[at[i, j], y]
                if not first <= span[0] < last or p < min_probability:
                    continue
                if before and span[0] < before[0][1]:
                    if p <= before[1]:
                        continue
                    out.pop()
                out.append(span)
                before = span, p
    return out


def all_spans(text: str, field: Field, min_probability: float = MIN_PROBABILITY) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans with those the field adds apart from them; by start, then kind."""
    def place(span: Span) -> tuple[int, int]:
        return span[0], KINDS.index(span[2])

    base = sorted(base_spans(text), key=place)
    more = apart(field_spans(text, field, min_probability), base)
    return base, sorted(base + more, key=place)


def train(docs: DataFrame, text: str = "text") -> Field:
    """A field for these documents; its sample is TRAINING_DOCS whole texts at most, which the driver holds."""
    rows = docs.select(docs[text].alias("text")).filter(F.col("text").rlike("[0-9@]"))
    rows = rows.select("text", F.xxhash64("text").alias("h"))
    smallest = rows.select("h").orderBy("h").limit(TRAINING_DOCS)
    last = smallest.agg(F.max("h")).first()[0]
    if last is None:
        return trained([])
    return trained([r.text for r in rows.filter(F.col("h") <= last).distinct().orderBy("h", "text").limit(TRAINING_DOCS).collect()])


SPANS = "array<struct<start:int,end:int,kind:string,base:boolean>>"


def find(
    docs: DataFrame, id: str = "doc_id", text: str = "text", field: Field | None = None,
    min_probability: float = MIN_PROBABILITY,
) -> DataFrame:
    """One row per document: ``id`` and ``spans``, structs of start, end (exclusive, code points), kind and base.

    ``base`` tells spans of the fixed patterns from those the field adds. A null or empty
    text has none; an empty table gives an empty result (the field is then trained on
    made-up stretches alone); repeated rows are judged one by one; other columns are left out.
    """
    known = docs.sparkSession.sparkContext.broadcast(field or train(docs, text))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = []
            for t in strings(batch):
                base, spans = all_spans(t, known.value, min_probability)
                own = set(base)
                rows.append([{"start": a, "end": b, "kind": k, "base": (a, b, k) in own} for a, b, k in spans])
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, type=kind)], names=[id, "spans"])

    rows = docs.select(docs[id].alias("id"), docs[text].alias("text"))
    return rows.mapInArrow(run, f"`{id}` {rows.schema['id'].dataType.simpleString()}, spans {SPANS}")
