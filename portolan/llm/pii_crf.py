"""Personal data by patterns and a linear-chain conditional random field.

Four kinds are found by fixed patterns with checks (the base spans).  The CRF
adds spans that the patterns do not state: numbers and addresses written in
other forms, judged by the shapes of the words and their neighbours.  It is
trained from a small labelled table (`labelled_sentences`) and decoded by
Viterbi, all runs of one length of a batch together.

A word without a digit and without an ``@`` is always labelled as outside, in
training and decoding.  Given such a word the two sides of the chain are
independent, so decoding every run between them is decoding the whole text.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portolan.llm.words import text_chunks, words_of

#: Kinds in their listed order (fixed values).
KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_HEX = frozenset("0123456789abcdefABCDEF")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str):
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``: each
    ``@`` with the run before it, so a text is passed once."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        else:
            free = at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in order.  Matches are
    leftmost and non-overlapping per kind; one that fails its check is
    dropped, and the search goes on behind it."""
    out = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


# --- features -------------------------------------------------------------

#: Cue words before a number or an address (fixed values).
CUES = ("call", "phone", "tel", "telephone", "mobile", "fax", "contact", "mail", "email", "e-mail", "card", "visa",
        "ip", "address", "host", "server", "version", "page", "section", "in", "token", "isbn", "order")
_ALNUM = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
_FIRST, _LAST = _ALNUM | frozenset("+(@:"), _ALNUM | frozenset(")")


def core(word: str) -> tuple[int, int]:
    """Span of a word without the punctuation around it; a colon stays in
    front where it is doubled, as short addresses begin."""
    start, end = 0, len(word)
    while start < end and (word[start] not in _FIRST or word[start] == ":" and word[start:start + 2] != "::"):
        start += 1
    while end > start and word[end - 1] not in _LAST:
        end -= 1
    if end > start and word[end - 1] == ")" and "(" not in word[start:end]:
        end -= 1
    return (start, end) if start < end else (0, len(word))


@cache
def _shape_class(char: str) -> str:
    return "0" if char in "0123456789" else "a" if char.isalpha() else char


def shape(word: str) -> str:
    """Character classes with run lengths: digits by their number up to 19,
    letters merged.  Classes behind the 24th are given by a hash of them all."""
    out, rest, k = [], 0, 0
    while k < len(word):
        c, run = _shape_class(word[k]), k
        while run < len(word) and _shape_class(word[run]) == c:
            run += 1
        own = f"0{min(run - k, 20)}" if c == "0" else c
        if len(out) < 24:
            out.append(own)
        else:
            rest = crc32(f"{own} ".encode(), rest or 1)
        k = run
    return "".join(out) + (f" {rest:08x}" if rest else "")


def features(word: str) -> list[str]:
    if not is_open(word):
        low = word.strip(".,;:!?()\"'").lower()
        return [f"w={low}"] if low in CUES else ["plain"]
    a, b = core(word)
    own = word[a:b]
    digits = _NOT_DIGIT.sub("", own)
    kinds = "".join(sorted({_shape_class(c) for c in own if _shape_class(c) not in "0a"}))
    out = [f"s={shape(own)}", f"d={min(len(digits), 20)}", f"k={kinds}", f"a={any(c.isalpha() for c in own)}"]
    if "@" in own:
        left, _, right = own.partition("@")
        out.append(f"@={bool(left)}{bool(right)}{right.isascii() and right.replace('.', '').replace('-', '').isalnum()}")
    if 12 <= len(digits) <= 19 and len(digits) + own.count(".") + own.count("/") + own.count("-") == len(own):
        out.append(f"luhn={luhn(digits)}")
    return out


def is_open(word: str) -> bool:
    """Words that may carry a label other than O."""
    return "@" in word or any(c in word for c in "0123456789")


# --- the labelled table -----------------------------------------------------

#: Sentences with slots, and the forms of each slot (fixed values).  A form is
#: digits drawn at random for ``#``; the label of a slot is its kind or O.
SENTENCES = (
    "call {phone} now", "phone {phone} or write", "tel {phone}", "reach us under {phone} today", "fax {phone}",
    "my number is {phone} thanks", "{phone}", "mail {email} please", "write to {email} soon", "{email}",
    "contact {email} or {phone}", "host {ip} is down", "server {ip}", "from {ip} at night", "card {card} was used",
    "paid with {card} yesterday", "visa {card}", "in {none} we met", "version {none} is out", "page {none}",
    "token = {none}", "section {none} says", "it cost {none} in all", "the {none} people came", "{none}",
    "order {none} has shipped", "at {none} it began", "some {none} people live there", "{none} rows were read", "isbn {none}", "on {none} they left", "and {none} of them", "between {none} and {none}")
FORMS = {
    "phone": ("(###) ###-####", "###-###-####", "###.###.####", "+1 (###) ###-####", "+49 ### #######",
              "0049 ### #######", "+1-###-###-####", "(0##) #### ####", "+33 # ## ## ## ##", "0## #######",
              "0### ########"),
    "email": ("jo.do##@mail#.example.com", "anna@host", "b.c@example.org", "x##@localhost", "ann_b@dept.example"),
    "ip": ("##.1##.##.#", "10.#.##.2##", "1##.1##.1##.##", "192.168.#.##:80##", "20##:db8:0:#::#", "20##:db8::#", "fe80::#a##:#",
           "::1"),
    "card": ("L16", "L4 4 4 4", "L4-4-4-4", "L4.4.4.4", "L15"),
    "none": ("#", "##", "###", "####", "19##", "20##", "#.#", "#.#.", "#,##", "##.##", "#,###", "20##-0#-1#", "1#:##",
             "##%", "(#)", "#-#", "##th", '"0a#b#cd##ef#a"', '"a#f##e#d#c##b#"', "CC-BY-#.#", "########", "X#",
             "N16", "N13", "978-#-##-######-#", "v#.#.#", "#/#", "##x##", "@", "@home", "#####", "######", "20##-0#-1# 1#:##:##", "20##/0#/1# 0#:##", "1#.0#.20## 1#:##",
             "## ### ### ###", "# ### ###", "### ### ###", "1#:##:##", "20##-0#-1#T1#:##:##Z", "# ## ### ####")}
#: Sentences of the table, drawn from the slots with a fixed seed.
SENTENCE_COUNT = 1500


def _fill(form: str, rng: np.random.Generator) -> str:
    if form[0] in "LN" and form[1:2].isdigit():
        groups = re.split(r"([ .-])", form[1:])
        size = sum(int(g) for g in groups[::2])
        while True:
            digits = "".join(map(str, rng.integers(0, 10, size)))
            if luhn(digits) == (form[0] == "L"):
                break
        out = []
        for k, g in enumerate(groups):
            out.append(g if k % 2 else digits[:int(g)])
            digits = digits if k % 2 else digits[int(g):]
        return "".join(out)
    return "".join(str(rng.integers(0, 10)) if c == "#" else c for c in form)


def labelled_sentences() -> list[tuple[list[str], list[str]]]:
    """The labelled table: words and their labels."""
    rng = np.random.default_rng(8)
    out = []
    for k in range(SENTENCE_COUNT):
        words, labels = [], []
        for part in SENTENCES[k % len(SENTENCES)].split():
            if not part.startswith("{"):
                words.append(part)
                labels.append("O")
                continue
            kind = part[1:-1]
            filled = _fill(FORMS[kind][rng.integers(len(FORMS[kind]))], rng).split()
            if rng.random() < 0.3:
                filled[-1] += ("." , ",", ";", "!!", "###", "%%%")[rng.integers(6)]
            words += filled
            labels += ["O"] * len(filled) if kind == "none" else [
                f"B-{kind}", *[f"I-{kind}"] * (len(filled) - 1)]
        out.append((words, [x if is_open(w) else "O" for w, x in zip(words, labels, strict=True)]))
    return out


# --- the model --------------------------------------------------------------

def runs_of(opened: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, end) of each run of open words."""
    edge = np.diff(np.concatenate([[0], opened.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _allowed() -> np.ndarray:
    """Transitions: an I label only follows its own kind; last row: from the start."""
    n = len(LABELS)
    out = np.zeros((n + 1, n))
    for b, name in enumerate(LABELS):
        if name.startswith("I-"):
            ok = {LABELS.index(f"B-{name[2:]}"), b}
            out[[a for a in range(n + 1) if a not in ok], b] = -1e9
    return out


class Crf:
    """Weights per (role, feature) and label, and per transition."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.weights = np.zeros((0, len(LABELS)))
        self.moves = _allowed()

    @staticmethod
    def names(words: list[str], k: int) -> list[str]:
        before = features(words[k - 1]) if k else ["edge"]
        after = features(words[k + 1]) if k + 1 < len(words) else ["edge"]
        return (["bias"] + features(words[k]) + [f"-{f}" for f in before if f[:2] in ("w=", "s=", "pl", "ed")]
                + [f"+{f}" for f in after if f[:2] in ("w=", "s=", "pl", "ed")])

    def emission(self, words: list[str], k: int) -> np.ndarray:
        known = [self.index[f] for f in self.names(words, k) if f in self.index]
        return self.weights[known].sum(axis=0)

    def fit(self, table: list[tuple[list[str], list[str]]], rounds: int = 150, rate: float = 0.1,
            ridge: float = 1e-3) -> Crf:
        """Maximum likelihood by full gradients; runs of one length together."""
        groups: dict[int, list[tuple[list[list[int]], list[int]]]] = {}
        for words, labels in table:
            first, end = runs_of(np.array([is_open(w) for w in words]))
            for a, b in zip(first, end, strict=True):
                ids = [[self.index.setdefault(f, len(self.index)) for f in self.names(words, k)] for k in range(a, b)]
                groups.setdefault(int(b - a), []).append((ids, [LABELS.index(x) for x in labels[a:b]]))
        self.weights = np.zeros((len(self.index), len(LABELS)))
        blocked = self.moves < -1e8
        packed = []
        for size, runs in groups.items():
            cells = [(r * size + t, f) for r, (ids, _) in enumerate(runs) for t, fs in enumerate(ids) for f in fs]
            packed.append((size, len(runs), np.array(cells), np.array([y for _, y in runs])))
        state = [np.zeros_like(x) for x in (self.weights, self.weights, self.moves, self.moves)]
        count = sum(p[1] for p in packed)
        for step in range(1, rounds + 1):
            gw, gm = np.zeros_like(self.weights), np.zeros_like(self.moves)
            for size, n, cells, gold in packed:
                scores = np.zeros((n * size, len(LABELS)))
                np.add.at(scores, cells[:, 0], self.weights[cells[:, 1]])
                node, pair = self._expectations(scores.reshape(n, size, -1))
                node[np.arange(n)[:, None], np.arange(size)[None], gold] -= 1
                np.add.at(gw, cells[:, 1], node.reshape(n * size, -1)[cells[:, 0]])
                gm += pair
                before = np.concatenate([np.full((n, 1), len(LABELS)), gold[:, :-1]], axis=1)
                np.add.at(gm, (before.ravel(), gold.ravel()), -1)
            for k, (x, g) in enumerate(((self.weights, gw), (self.moves, np.where(blocked, 0, gm)))):
                g = g / count + ridge * np.where(blocked, 0, x) if k else g / count + ridge * x
                m, v = state[2 * k], state[2 * k + 1]
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g * g
                x -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        return self

    def _expectations(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label marginals and summed transition expectations (forward-backward)."""
        n, size, labels = scores.shape
        moves, first = self.moves[:-1], self.moves[-1]
        alpha, beta = np.empty_like(scores), np.zeros_like(scores)
        alpha[:, 0] = first + scores[:, 0]
        for t in range(1, size):
            alpha[:, t] = np.logaddexp.reduce(alpha[:, t - 1, :, None] + moves, axis=1) + scores[:, t]
        for t in range(size - 2, -1, -1):
            beta[:, t] = np.logaddexp.reduce(moves + (scores[:, t + 1] + beta[:, t + 1])[:, None], axis=2)
        z = np.logaddexp.reduce(alpha[:, -1], axis=1)[:, None, None]
        node = np.exp(alpha + beta - z)
        pair = np.zeros_like(self.moves)
        pair[-1] = node[:, 0].sum(axis=0)
        for t in range(1, size):
            pair[:-1] += np.exp(alpha[:, t - 1, :, None] + moves + (scores[:, t] + beta[:, t])[:, None] - z).sum(axis=0)
        return node, pair

    def viterbi(self, scores: np.ndarray) -> np.ndarray:
        """Best label path of each run (runs x length x labels)."""
        n, size, labels = scores.shape
        best, back = self.moves[-1] + scores[:, 0], np.zeros((n, size, labels), dtype=np.int8)
        for t in range(1, size):
            total = best[:, :, None] + self.moves[:-1]
            back[:, t] = total.argmax(axis=1)
            best = total.max(axis=1) + scores[:, t]
        path = np.empty((n, size), dtype=np.int64)
        path[:, -1] = best.argmax(axis=1)
        for t in range(size - 1, 0, -1):
            path[:, t - 1] = back[np.arange(n), t, path[:, t]]
        return path


@cache
def trained() -> Crf:
    return Crf().fit(labelled_sentences())


_OPEN = np.zeros(256, dtype=bool)
_OPEN[list(b"0123456789@")] = True


def _crf_spans(model: Crf, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, bytes]]:
    """(row, kind, first byte, end byte, text) of the decoded spans; bytes of
    the chunk."""
    words = words_of(data, offsets)
    marks = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(_OPEN[data], out=marks[1:])
    opened = marks[words.end] > marks[words.start]
    # a run ends with its row
    where = np.flatnonzero(opened)
    if not len(where):
        return []
    split = (np.diff(where) > 1) | (np.diff(words.row[where]) > 0)
    first = where[np.concatenate([[0], np.flatnonzero(split) + 1])]
    end = where[np.concatenate([np.flatnonzero(split), [len(where) - 1]])] + 1
    raw = data.tobytes()

    def word(k: int, row: int) -> list[str]:
        if k < 0 or k >= len(words.row) or words.row[k] != row:
            return []
        return [raw[words.start[k]:words.end[k]].decode("utf-8", "replace")]

    groups: dict[int, list[tuple[int, np.ndarray]]] = {}
    for a, b in zip(first.tolist(), end.tolist(), strict=True):
        row = words.row[a]
        left = word(a - 1, row)
        text = left + [w for k in range(a, b) for w in word(k, row)] + word(b, row)
        scores = np.array([model.emission(text, k) for k in range(len(left), len(left) + b - a)])
        groups.setdefault(b - a, []).append((a, scores))
    out = []
    for size, runs in groups.items():
        paths = model.viterbi(np.stack([s for _, s in runs]))
        for r in np.flatnonzero(paths.any(axis=1)):
            a, t = runs[r][0], 0
            while t < size:
                label = LABELS[paths[r, t]]
                u = t + 1
                if label != "O":
                    while u < size and LABELS[paths[r, u]] == f"I-{label[2:]}":
                        u += 1
                    s, e = int(words.start[a + t]), int(words.end[a + u - 1])
                    out.append((int(words.row[a]), KINDS.index(label[2:]), s, e, raw[s:e]))
                t = u
    return out


#: Words that are a date or a time of day, never part of a phone number.
_WHEN = re.compile(r"(?:(?:19|20)[0-9]{2}[-./][01]?[0-9][-./][0-3]?[0-9]|[0-3]?[0-9][./][01]?[0-9][./](?:19|20)[0-9]{2}"
                   r"|[0-2]?[0-9]:[0-5][0-9](?::[0-5][0-9])?)(?:[T ].*)?Z?")


def _address(text: str) -> bool:
    """Four numbers up to 255 and perhaps a port, or eight hexadecimal groups,
    fewer with a double colon."""
    if text.count(".") == 3:
        parts = text.partition(":")[0].split(".")
        return all(p.isascii() and p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in parts)
    groups = text.split(":")
    named = [g for g in groups if g]
    if not named or len(groups) > 9 or any(len(g) > 4 or set(g) - _HEX for g in named):
        return False
    return text.count("::") == 1 and ":::" not in text or len(named) == len(groups) == 8


def _plausible(kind: int, text: str) -> bool:
    """What a span of the kind must hold: digits within the kind's counts, an
    address its parts, and no date or time in a phone number."""
    digits = _NOT_DIGIT.sub("", text)
    return {0: "@" in text[1:-1], 1: _address(text), 2: 12 <= len(digits) <= 19 and luhn(digits),
            3: 9 <= len(digits) <= 15 and not any(_WHEN.fullmatch(w) for w in text.split())}[kind]


def _covered(spans: list[tuple[int, int, int]]) -> tuple[list[int], list[int]]:
    """(starts, ends) of the disjoint parts that sorted spans cover."""
    firsts: list[int] = []
    ends: list[int] = []
    for start, _, end in spans:
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            firsts.append(start)
            ends.append(end)
    return firsts, ends


SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def _finder(model: Crf):
    """mapInArrow: (id, text) -> (id, spans)."""
    kind_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                    ("base", pa.bool_())]))

    def run(batches):
        for batch in batches:
            for i, j, data, offsets in text_chunks(batch.column(1)):
                marks = np.concatenate([[0], np.cumsum(_OPEN[data])])
                some = marks[offsets[1:]] > marks[offsets[:-1]]
                extra: dict[int, list] = {}
                for row, kind, s, e, raw in _crf_spans(model, data, offsets):
                    extra.setdefault(row, []).append((kind, s, e, raw.decode("utf-8", "replace")))
                out = []
                for k in range(j - i):
                    if not some[k]:  # no digit, no @: nothing to find
                        out.append([])
                        continue
                    raw = data[offsets[k]:offsets[k + 1]].tobytes()
                    text = raw.decode("utf-8", "replace")
                    base = base_spans(text)
                    spans = [(s, kind, e, True) for s, kind, e in base]
                    firsts, ends = _covered(base)
                    at = points = 0  # bytes and code points up to the last span
                    for kind, s, _, found in sorted(extra.get(k, ()), key=lambda x: x[1]):
                        points += len(raw[at:s - offsets[k]].decode("utf-8", "replace"))
                        at = s - offsets[k]
                        a, b = core(found)
                        if not _plausible(kind, found[a:b]):
                            continue
                        start, stop = points + a, points + b
                        near = bisect_left(firsts, stop)  # the covered parts that begin before the span's end
                        if not near or ends[near - 1] <= start:
                            spans.append((start, kind, stop, False))
                    out.append([{"kind": KINDS[kind], "start": s, "end": e, "base": own}
                                for s, kind, e, own in sorted(spans)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(out, type=kind_type)], names=["id", "spans"])
    return run


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: (id, spans), spans ordered by start, then kind as listed.

    A span has its kind, start and exclusive end in code points, and whether a
    fixed pattern found it; a span of the CRF that overlaps one of those is
    left out.  Null and empty texts have no spans; repeated rows get a row
    each; null ids stay; other columns are not read.
    """
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("_text"))
    id_type = base.schema["id"].dataType.simpleString()
    return base.mapInArrow(_finder(trained()), f"id {id_type}, spans {SPANS}").withColumnRenamed("id", id_col)
