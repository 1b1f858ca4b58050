"""PII: base patterns, and a character-level BiLSTM-CRF that adds spans.

The tagger is fitted on windows with labelled spans. Any text position within
reach of a digit, an at sign or a quoted value lies in windows that overlap by half; the
scores of a position are averaged over its windows, and one CRF decoding over
the whole stretch reconciles them. Text farther away has no tag but O. The tagger
finds secrets by itself; the rule that labelled them only adds those it misses, and each span
says where it comes from (base, tagger, rule).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsmill.llm import tagger, words
from opsmill.llm.names import free

KINDS = ("email", "ip", "card", "phone")  # base kinds, in the order of listing
TAGGED = (*KINDS, "secret")
WIDTH, STRIDE = 64, 32
FIT_WINDOWS, MADE_WINDOWS = 800, 600  # bounds of what the tagger is fitted on
LEAST_SECRET = 12  # characters of a secret outside quotes

_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_NUMBERS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Labels: a quoted value that a name says is secret.
_VALUE = r"[=:]\s{0,3}[\"']([^\"'\s]{8,80}+)[\"']"
_QUOTED = re.compile(_VALUE)
_SPOTS = re.compile(r"[0-9@]+|[=:]\s{0,3}[\"']")  # where the tagger looks
_SECRET = re.compile(r"(?i)(?:token|secret|api_?key|password|passwd)\s{0,3}" + _VALUE)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start. Linear in the text: runs are
    matched possessively, and an address is sought from its at sign."""
    out, last = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            i = m.start()
            while i > last and text[i - 1] in _LOCAL:
                i -= 1
            if i < m.start():
                out.append(("email", i, m.end()))
                last = m.end()
    for m in _NUMBERS.finditer(text):
        if m[0].count(".") >= 3:
            at, parts = m.start(), m[0].split(".")
            for k in range(0, len(parts) - 3, 4):
                four = parts[k:k + 4]
                size = sum(map(len, four)) + 3
                if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in four):
                    out.append(("ip", at, at + size))
                at += size + 1
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


def secret_spans(text: str) -> list[tuple[str, int, int]]:
    if not _QUOTED.search(text):
        return []
    return [("secret", m.start(1), m.end(1)) for m in _SECRET.finditer(text)]


def _tags(n: int, spans, shift: int = 0) -> np.ndarray:
    """O is 0; kind k begins with 1 + 2k and goes on with 2 + 2k."""
    tags = np.zeros(n, np.int64)
    for kind, a, b in spans:
        a, b, k = a - shift, b - shift, TAGGED.index(kind)
        if b > 0 and a < n:
            tags[max(a, 0):min(b, n)] = 2 + 2 * k
            if a >= 0:
                tags[a] = 1 + 2 * k
    return tags


def _window(text: str, at: int) -> tuple[str, int]:
    start = max(0, at)
    return text[start:start + WIDTH].ljust(WIDTH, "\n"), start


def _made(n: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Windows made by rule, so that each kind is known whatever the corpus
    holds, and look-alikes (years, sizes, versions, prices, quoted words) that are no spans."""
    rng = np.random.default_rng(5)

    def pick(chars, a, b):
        return "".join(rng.choice(list(chars), rng.integers(a, b + 1)))

    letters, digits, out = "abcdefghijklmnopqrstuvwxyz", "0123456789", []
    while len(out) < n:
        words_ = lambda k: " ".join(pick(letters, 1, 9) for _ in range(k))
        kind = ("email", "ip", "card", "phone", "secret", "")[len(out) % 6]
        if kind == "email":
            value = f"{pick(letters, 2, 8)}.{pick(digits, 1, 3)}@{pick(letters, 3, 8)}.{rng.choice(['com', 'org', 'net', 'example.com'])}"
        elif kind == "ip":
            value = ".".join(str(rng.integers(0, 256)) for _ in range(4))
        elif kind == "card":
            value = pick(digits, 15, 15)
            value += next(d for d in digits if luhn(value + d))
        elif kind == "phone":
            value = f"+{rng.integers(1, 99)} ({pick(digits, 3, 3)}) {pick(digits, 3, 3)}-{pick(digits, 4, 4)}"
        elif kind == "secret":
            value = pick("0123456789abcdef", 24, 64) if len(out) % 12 < 6 else pick(letters + letters.upper() + digits, 20, 48)
        else:
            value = str(rng.choice([f"{rng.integers(1900, 2030)}", f"{pick(digits, 1, 2)}.{pick(digits, 1, 1)}", f"page {pick(digits, 1, 4)}",
                                    f"{pick(digits, 1, 3)},{pick(digits, 3, 3)}", f"{pick(digits, 13, 16)}x", f"{pick(digits, 2, 2)}:{pick(digits, 2, 2)}"]))
        if not kind and len(out) % 12 < 6:
            name = rng.choice(["title", "name", "label", "path", "type", "unit", "see", "class"])
            value = f"{name}{rng.choice([' = ', ': ', '='])}\"{pick(letters, 4, 14)}{rng.choice(['', '-' + pick(letters, 3, 9)])}\""
        before = words_(int(rng.integers(0, 4)))
        before += f" {rng.choice(['token', 'secret', 'api_key', 'key'])} = \"" if kind == "secret" else " "
        text = before + value + ("\"" if kind == "secret" else "") + str(rng.choice([" ", ".\n", ", ", "### ", "*** "])) + words_(9)
        spans = [(kind, len(before), len(before) + len(value))] if kind else []
        out.append((text, spans))
    return out


def _cases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One labelled window per text that has a digit, an at sign or a quoted value, with a hash to draw by."""
    for batch in batches:
        hashes, texts, spans = [], [], []
        for text in batch.column(0).to_pylist():
            if not text or not _SPOTS.search(text):
                continue
            h = hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest()
            hits = [m.start() for m in _SPOTS.finditer(text)]
            at = hits[h[0] % len(hits)] - 4 - h[1] % 30
            window, start = _window(text, at)
            hashes.append(int.from_bytes(h, "little", signed=True))
            texts.append(window)
            near = text[max(0, start - 200):start + WIDTH + 200]
            shift = start - max(0, start - 200)
            spans.append(",".join(f"{k}:{a - shift}:{b - shift}" for k, a, b in base_spans(near) + secret_spans(near)))
        yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(texts, pa.string()), pa.array(spans, pa.string())], names=["h", "window", "spans"])


@dataclass(frozen=True)
class Model:
    parameters: dict[str, np.ndarray]


def fit(docs: DataFrame, text: str = "text", epochs: int = 8) -> Model:
    """A tagger from at most FIT_WINDOWS windows of ``docs``, taken in order of
    a hash of the text, and MADE_WINDOWS windows made by rule."""
    rows = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(_cases, "h long, window string, spans string")
    drawn = rows.groupBy("h", "window", "spans").agg(F.count(F.lit(1)).alias("n")).orderBy("h", "window").limit(FIT_WINDOWS).collect()
    cases = [(r.window, [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in r.spans.split(",") if s)]) for r in drawn]
    return train(cases + _made(MADE_WINDOWS), epochs)


def train(cases: list[tuple[str, list[tuple[str, int, int]]]], epochs: int = 8) -> Model:
    """A tagger from texts with labelled spans (the first WIDTH characters count)."""
    x = np.stack([tagger.kinds(t[:WIDTH].ljust(WIDTH, "\n")) for t, _ in cases])
    tags = np.stack([_tags(WIDTH, s) for _, s in cases])
    return Model(tagger.train(x, tags, 1 + 2 * len(TAGGED), epochs))


def _stretches(text: str) -> list[tuple[int, int]]:
    """Parts of the window grid, in windows, that hold every digit, at sign and
    beginning of a quoted value with half a window of text around it."""
    last = max(0, -(-(len(text) - WIDTH) // STRIDE))
    grid: list[list[int]] = []
    for m in _SPOTS.finditer(text):
        a = min(last, max(0, (m.start() - STRIDE) // STRIDE))
        b = min(last, (m.end() - 1 + STRIDE // 2) // STRIDE)
        if grid and a <= grid[-1][1] + 1:
            grid[-1][1] = max(b, grid[-1][1])
        else:
            grid.append([a, b])
    return [(a, b) for a, b in grid]


def _scores(model, windows: list[str]) -> np.ndarray:
    x = np.stack([tagger.kinds(w) for w in windows])
    return np.concatenate([tagger.emissions(model, x[k:k + 512]) for k in range(0, len(x), 512)])


def _decode(model, text: str, first: int, scores: np.ndarray) -> list[tuple[str, int, int]]:
    """Spans of one stretch of windows: averaged scores, one decoding."""
    size = STRIDE * (len(scores) - 1) + WIDTH
    total, seen = np.zeros((size, scores.shape[2]), np.float32), np.zeros((size, 1), np.float32)
    weight = np.minimum(np.arange(1, WIDTH + 1), np.arange(WIDTH, 0, -1)).astype(np.float32)[:, None]
    for i, s in enumerate(scores):  # what lies near a window's edge counts less
        total[i * STRIDE:i * STRIDE + WIDTH] += weight * s
        seen[i * STRIDE:i * STRIDE + WIDTH] += weight
    base = first * STRIDE
    tags = tagger.viterbi((total / seen)[:len(text) - base], model["T"])
    out, start = [], None
    for i, t in enumerate([*tags.tolist(), 0]):
        if start is not None and (t == 0 or t % 2 == 1 or (t - 1) // 2 != start[1]):
            out.append((TAGGED[start[1]], base + start[0], base + i))
            start = None
        if t % 2 == 1:
            start = (i, (t - 1) // 2)
    return out


def _trusted(text: str, span: tuple[str, int, int]) -> bool:
    """Whether a span of the tagger is whole: it ends where a word ends, and
    has the digits and the length that its kind cannot do without."""
    kind, a, b = span
    value = text[a:b]
    digits = sum(c.isdigit() for c in value)
    if (a and text[a - 1].isalnum() and value[0].isalnum()) or (b < len(text) and text[b].isalnum() and value[-1].isalnum()):
        return False
    if kind == "email":
        return "@" in value and "." in value[value.index("@"):] and len(value) >= 6
    if kind == "ip":
        return value.count(".") == 3 and 4 <= digits <= 12
    if kind == "card":
        return 13 <= digits <= 19 and luhn(re.sub("[^0-9]", "", value))
    if kind == "phone":
        return 9 <= digits <= 15 and value[0] in "+(0123456789"
    if _quotes(text, a, b) == (a, b):
        return 8 <= len(value) <= 80
    return len(value) >= LEAST_SECRET and digits >= 2 and any(c.isalpha() for c in value) and not any(c.isspace() for c in value)


def _quotes(text: str, a: int, b: int) -> tuple[int, int] | None:
    """The quoted value behind an equals sign or colon that a span lies in."""
    for m in _QUOTED.finditer(text, max(0, a - 90), b + 90):
        if m.start(1) <= a and b <= m.end(1):
            return m.span(1)
    return None


def _whole(text: str, span: tuple[str, int, int]) -> tuple[str, int, int]:
    """A secret grown to the quotes it stands in, else to the ends of its run of
    letters, digits and dashes."""
    kind, a, b = span
    if kind == "secret":
        if found := _quotes(text, a, b):
            return kind, *found
        while a and (text[a - 1].isalnum() or text[a - 1] in "-_"):
            a -= 1
        while b < len(text) and (text[b].isalnum() or text[b] in "-_"):
            b += 1
    return kind, a, b


def find(texts: list[str], model: dict[str, np.ndarray], rule: bool = True) -> list[list[tuple[str, int, int, str]]]:
    """All spans (kind, start, end, origin) of each text: base ones, those of the tagger that touch
    none of them, and, with ``rule``, labelled secrets that no span covers."""
    out: list[list] = []
    jobs, windows = [], []
    for i, text in enumerate(texts):
        out.append([])
        if not text or not _SPOTS.search(text):
            continue
        out[i] += [(*s, "base") for s in base_spans(text)]
        for a, b in _stretches(text):
            jobs.append((i, a, len(windows), b - a + 1))
            windows += [text[k * STRIDE:k * STRIDE + WIDTH].ljust(WIDTH, "\n") for k in range(a, b + 1)]
            if len(windows) >= 4096:
                _add(texts, model, jobs, windows, out)
                jobs, windows = [], []
    _add(texts, model, jobs, windows, out)
    if rule:
        for i, text in enumerate(texts):
            for s in secret_spans(text or ""):
                if not any(a <= s[1] and s[2] <= b for _, a, b, _ in out[i]):
                    # What the tagger saw of it only in part gives way to the whole.
                    out[i] = [x for x in out[i] if x[3] != "tagger" or x[2] <= s[1] or s[2] <= x[1]] + [(*s, "rule")]
    order = {k: n for n, k in enumerate(TAGGED)}
    return [sorted(s, key=lambda x: (order[x[0]], x[1])) for s in out]


def _add(texts, model, jobs, windows, out) -> None:
    if not windows:
        return
    scores = _scores(model, windows)
    for i, first, at, n in jobs:
        for span in dict.fromkeys(_whole(texts[i], s) for s in _decode(model, texts[i], first, scores[at:at + n])):
            if all(span[2] <= a or b <= span[1] for _, a, b, _ in out[i]) and _trusted(texts[i], span):
                out[i].append((*span, "tagger"))


def detect(docs: DataFrame, model: Model, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with ``out``, an array of (kind, start, end, base, origin) in code
    points, end exclusive, by kind and start (a column of that name is
    replaced). Null and empty texts have none; repeated rows have the same."""
    keep = [c for c in docs.columns if c != out]
    source = text if text in keep else free("body", docs.columns)
    sent = docs.sparkSession.sparkContext.broadcast(model.parameters)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("origin", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.chunks(batches, source):
            at = {f.name: i for i, f in enumerate(batch.schema)}
            texts = [t or "" for t in batch.column(at[source]).to_pylist()]
            made = [[{"kind": k, "start": a, "end": b, "base": o == "base", "origin": o} for k, a, b, o in spans] for spans in find(texts, sent.value)]
            yield pa.RecordBatch.from_arrays([*(batch.column(at[c]) for c in keep), pa.array(made, kind)], names=[*keep, out])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"`{text}`").alias(source)] * (source != text))
    return rows.mapInArrow(run, f"{fields + ', ' if fields else ''}`{out}` array<struct<kind:string,start:int,end:int,base:boolean,origin:string>>")


def mask(text, spans):
    """``text`` (column) with each span replaced by its kind in brackets; where
    spans overlap, the earlier and longer one counts."""
    order = F.sort_array(F.transform(spans, lambda s: F.struct(s.start.alias("a"), (-s.end).alias("b"), s.kind.alias("k"))))
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(acc, s):
        return F.when(s.a < acc["at"], acc).otherwise(F.struct(
            F.concat(acc.done, F.substring(text, acc["at"] + 1, s.a - acc["at"]), F.lit("["), F.upper(s.k), F.lit("]")).alias("done"),
            (-s.b).alias("at")))

    return F.when(F.size(spans) > 0, F.aggregate(order, start, step, lambda acc: F.concat(
        acc.done, F.substring(text, acc["at"] + 1, F.length(text))))).otherwise(text)


def mask_documents(docs: DataFrame) -> DataFrame:
    """Documents with their personal data masked; columns stay as they are
    (``n_chars``, where there is one, follows the text)."""
    spans = free("spans", docs.columns)
    masked = free("masked", [*docs.columns, spans])
    found = detect(docs, fit(docs), out=spans).withColumn(masked, mask(F.col("text"), F.col(spans)))
    new = {"text": F.col(masked)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(masked).cast(docs.schema["n_chars"].dataType)
    return found.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
