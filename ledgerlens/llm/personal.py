"""Personal data by patterns and a semi-Markov conditional random field (operator 9).

Fixed patterns give the base spans (email, ip, card, phone). Words with digits,
``@`` or ``at`` in brackets that no base span covers, and words around a bare
``at`` that a ``dot`` follows, form zones with a word of context on each side. In
a zone a semi-Markov CRF scores every segment of up to ``LONGEST`` words under
every kind by features of the whole segment (its character shape, its digits,
validity checks, the word before it), and dynamic programming picks the best
joint choice of boundaries and kinds; segments it labels are added to the base.

* The CRF is trained here by maximum likelihood on zones of a bounded sample of
  documents (``SAMPLE``, those with the smallest checksum of the id) whose labels
  are the base spans, and on variants of these that the patterns do not accept
  (a phone number without ``+``, a card number in dots, an address with ``(at)``,
  ``[at]`` or `` at ... dot ``). Zones without a span serve as outside, except
  where they resemble an entity: those may be forms that the patterns miss.
* Null and empty texts have no spans. Spans are in code points, end exclusive.
* Rows are judged by themselves; repeated rows keep their own results. An empty
  table gives no rows. ``find`` reads doc_id and text only; ``masked`` returns
  the columns it was given.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.stored import giving_back
from ledgerlens.llm.words import Texts, slices

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)
#: Words of the longest entity.
LONGEST = 5
SAMPLE = 400
#: Zones used for training, and passes over them.
ZONES = 240
#: Rows masked at a time, so the texts in memory twice do not follow the batch.
ROWS = 1000
PASSES = 6
RATE = 0.3
SHRINK = 1e-3
#: Ties, and a model without training data, go outside.
TIE = 1e-9

SPANS = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

# Fixed patterns of the base spans. Possessive forms and the check of the two
# characters before a number only save time: a match cannot begin inside a number.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]", re.IGNORECASE)
#: An address in words; its words open a zone like those with a trigger.
SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\s++at\s+[A-Za-z0-9-]+(?:\s+dot\s+[A-Za-z0-9-]+)+", re.IGNORECASE)
#: The forms of an ``at`` that stands for ``@``, and what no pattern accepts but an entity may look like.
AT = re.compile(r"[(\[]at[)\]]|\sat\s.*\sdot\s", re.IGNORECASE)
LIKENESS = re.compile(r"\S@\S|\S\s?[(\[]at[)\]]\s?\S|[0-9](?:[\s().-]*[0-9]){8}|[0-9]+(?:\.[0-9]+){3}", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of EMAIL; the leftmost begins where the run of local characters before an ``@`` does."""
    done = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        found = EMAIL.match(text, begin) if begin < at else None
        done = found.end() if found else at + 1
        if found:
            yield found.span()
        at = text.find("@", done)


def valid_ip(part: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x[-18:]) <= 255 for x in part.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base spans, by start and kind."""
    out = [(a, 0, b) for a, b in emails(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if valid_ip(m[0])]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(DIGIT.findall(m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def shape(segment: str) -> str:
    """Classes of characters, runs of one class by length up to a bound."""
    out, last, run = [], "", 0
    for c in segment:
        kind = "9" if c.isdigit() else "a" if c.isalpha() else c
        if kind == last:
            run += 1
        else:
            if last:
                out.append(f"{last}{min(run, 5)}" if last in "9a" else last)
            last, run = kind, 1
    out.append(f"{last}{min(run, 5)}" if last in "9a" else last)
    return "".join(out)[:60]


def features(words: list[str], i: int, j: int) -> list[str]:
    """Features of the whole segment ``words[i:j]``."""
    segment = " ".join(words[i:j]).strip(".,;:!?\"'")
    digits = "".join(c for c in segment if "0" <= c <= "9")
    letters = sum(c.isalpha() for c in segment)
    parts = segment.split(".")
    out = [
        "bias",
        f"shape={shape(segment)}",
        f"words={j - i}",
        f"digits={min(len(digits), 20)}",
        f"letters={min(letters, 6)}",
        f"at={'@' in segment or bool(AT.search(segment))}/{segment.rfind('.') > segment.find('@')}/{letters > 4}",
        f"before={words[i - 1].lower().strip(':.,') if i else ''}",
    ]
    if letters == 0:
        out.append(f"luhn={12 <= len(digits) <= 19 and luhn(digits)}")
        out.append(f"four={len(parts) == 4 and all(p.isdigit() and int(p[:9]) <= 255 for p in parts)}")
        out.append(f"plain={9 <= len(digits) <= 15}/{segment[:1]}/{'(' in segment}/{j - i}")
    return out


def chart(words: list[str], weights: dict, fixed=None) -> dict[tuple[int, int], np.ndarray]:
    """Score of every segment under every kind; segments of several words are never outside."""
    out = {}
    for i in range(len(words)):
        for j in range(i + 1, min(len(words), i + LONGEST) + 1):
            scores = np.zeros(OUTSIDE + 1)
            scores[OUTSIDE] = TIE
            for name in (fixed or {}).get((i, j)) or features(words, i, j):
                found = weights.get(name)
                if found is not None:
                    scores += found
            if j - i > 1:
                scores[OUTSIDE] = -np.inf
            out[i, j] = scores
    return out


def best_path(words: list[str], weights: dict) -> list[tuple[int, int, int]]:
    """The entities (i, j, kind) of the best segmentation."""
    scores, n = chart(words, weights), len(words)
    best, back = [0.0] + [-math.inf] * n, [None] * (n + 1)
    for j in range(1, n + 1):
        for i in range(max(0, j - LONGEST), j):
            kind = int(scores[i, j].argmax())
            value = best[i] + scores[i, j][kind]
            if value > best[j]:
                best[j], back[j] = value, (i, j, kind)
    out, j = [], n
    while j:
        out.append(back[j])
        j = back[j][0]
    return [x for x in reversed(out) if x[2] != OUTSIDE]


def expectations(scores: dict, n: int) -> dict[tuple[int, int], np.ndarray]:
    """Probability of every (segment, kind), by sums over all segmentations."""
    add = lambda values: (m := max(values)) + math.log(sum(math.exp(v - m) for v in values)) if values else -math.inf
    whole = {k: add([float(x) for x in v if x > -np.inf]) for k, v in scores.items()}
    ahead, behind = [0.0] + [0.0] * n, [0.0] * (n + 1)
    for j in range(1, n + 1):
        ahead[j] = add([ahead[i] + whole[i, j] for i in range(max(0, j - LONGEST), j)])
    for i in range(n - 1, -1, -1):
        behind[i] = add([whole[i, j] + behind[j] for j in range(i + 1, min(n, i + LONGEST) + 1)])
    return {(i, j): np.exp(ahead[i] + v + behind[j] - ahead[n]) for (i, j), v in scores.items()}


def train(zones: list[tuple[list[str], list[tuple[int, int, int]]]]) -> dict[str, np.ndarray]:
    """Weights by adaptive gradient steps on the likelihood of the labelled segmentations."""
    weights, spread = {}, {}
    for _ in range(PASSES):
        for words, entities in zones:
            n = len(words)
            fixed = {(i, j): features(words, i, j) for i in range(n) for j in range(i + 1, min(n, i + LONGEST) + 1)}
            inside = {k for i, j, _ in entities for k in range(i, j)}
            gold = {(i, j): kind for i, j, kind in entities} | {(k, k + 1): OUTSIDE for k in range(n) if k not in inside}
            slope: dict[str, np.ndarray] = {}
            for where, chance in expectations(chart(words, weights, fixed), n).items():
                change = -chance
                if where in gold:
                    change[gold[where]] += 1
                for name in fixed[where]:
                    slope[name] = slope[name] + change if name in slope else change.copy()
            for name, change in slope.items():
                now = weights.setdefault(name, np.zeros(OUTSIDE + 1))
                change = change - SHRINK * now
                seen = spread.setdefault(name, np.full(OUTSIDE + 1, 1e-8))
                seen += change**2
                now += RATE * change / np.sqrt(seen)
    return {k: v for k, v in weights.items() if np.abs(v).max() > 1e-3}


def word_spans(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in WORD.finditer(text)]


def zones_of(text: str, spans: list[tuple[int, int]], taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Word ranges with triggers outside ``taken`` and a word of context; taken words end a zone."""
    used = np.zeros(len(spans), bool)
    begins = [a for a, _ in spans]
    for a, _, b in taken:
        i = int(np.searchsorted(begins, a, side="right")) - 1
        while i < len(spans) and spans[i][0] < b:
            used[max(i, 0)] = True
            i += 1
    end = 0
    opens = np.zeros(len(spans), bool)
    opens[np.searchsorted(begins, [m.start() for m in TRIGGER.finditer(text)], side="right") - 1] = True
    for m in SPELLED.finditer(text):
        opens[int(np.searchsorted(begins, m.start(), side="right")) - 1 : int(np.searchsorted(begins, m.end()))] = True
    hot = np.flatnonzero(opens & ~used).tolist()
    for k in hot:
        if k < end:
            continue
        low, high = k, k + 1
        low -= low > end and not used[low - 1]
        while high < len(spans) and not used[high] and opens[high]:
            high += 1
        high += high < len(spans) and not used[high]
        end = high
        yield low, high


def labelled_zone(text: str, span: tuple[int, int, int]) -> tuple[list[str], list[tuple[int, int, int]]] | None:
    """The words of one base span with two words of context on each side, and its label."""
    a, kind, b = span
    left = WORD.findall(text[max(0, a - 80) : a])[-2:]
    right = WORD.findall(text[b : b + 80])[:2]
    inner = WORD.findall(text[a:b])
    if not inner or len(inner) > LONGEST or (a and not text[a - 1].isspace()):
        return None
    return left + inner + right, [(len(left), len(left) + len(inner), kind)]


def variants(words: list[str], entity: tuple[int, int, int]) -> Iterator[tuple[list[str], list[tuple[int, int, int]]]]:
    """The zone with its entity in forms that the patterns miss."""
    i, j, kind = entity
    inner, forms = words[i:j], []
    if kind == 0:
        name, host = inner[0].split("@", 1)
        forms = [[f"{name}(at){host}"], [f"{name}[at]{host}"]]
        spelled = [name, "at", *" dot ".join(host.split(".")).split()]
        if len(spelled) <= LONGEST:
            forms.append(spelled)
    elif kind == 2 and len(inner) == 1 and inner[0].isdigit():
        forms = [[".".join(inner[0][k : k + 4] for k in range(0, len(inner[0]), 4))]]
    elif kind == 3:
        forms = [inner[1:] if len(inner) > 2 else [inner[0].lstrip("+"), *inner[1:]]]
    for form in forms:
        yield words[:i] + form + words[j:], [(i, i + len(form), kind)]


def training_zones(text: str) -> Iterator[tuple[list[str], list[tuple[int, int, int]]]]:
    """Zones of base spans, of their variants, and of triggers that no pattern accepts."""
    found = base_spans(text)
    for span in found:
        zone = labelled_zone(text, span)
        if zone:
            yield zone
            yield from variants(zone[0], zone[1][0])
    spans = word_spans(text)
    for i, j in zones_of(text, spans, found):
        words = [text[a:b] for a, b in spans[i : min(j, i + 4 * LONGEST)]]
        joined = " ".join(words)
        if not LIKENESS.search(joined) and not SPELLED.search(joined):
            yield words, []


def fit(documents: DataFrame, sample: int = SAMPLE, most: int = ZONES) -> dict[str, np.ndarray]:
    """Weights from ``most`` zones of about ``sample`` documents that have a digit or ``@``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            zones = {json.dumps(z) for t in batch.column("text").to_pylist() for z in training_zones(t)}
            rows = sorted((hashlib.sha256(z.encode()).hexdigest(), z) for z in zones)
            yield pa.RecordBatch.from_pylist([{"rank": r, "zone": z} for r, z in rows[:most]], arrow)

    arrow = pa.schema([("rank", pa.string()), ("zone", pa.string())])
    useful = documents.where(F.col("text").rlike("[0-9@]"))
    draw = F.crc32(F.concat(F.lit("zones:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    chosen = useful.where(draw < sample / max(1, useful.count()) * 2.0**32).select("text")
    first = chosen.mapInArrow(run, "rank string, zone string").distinct().orderBy("rank").limit(most).collect()
    return train([(words, [tuple(e) for e in entities]) for words, entities in (json.loads(r["zone"]) for r in first)])


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{b}" for a, kind, b in spans)


def added_spans(text: str, base: list[tuple[int, int, int]], weights: dict) -> list[tuple[int, int, int]]:
    spans = word_spans(text)
    out = []
    for i, j in zones_of(text, spans, base):
        words = [text[a:b] for a, b in spans[i:j]]
        for k, m, kind in best_path(words, weights):
            a, b = spans[i + k][0], spans[i + m - 1][1]
            while b > a and text[b - 1] in ".,;:!?\"'":
                b -= 1
            if b > a:
                out.append((a, kind, b))
    return out


TRIGGERS = np.zeros(256, bool)
TRIGGERS[list(b"0123456789@")] = True
OPENS, CLOSES = np.zeros(256, bool), np.zeros(256, bool)
OPENS[list(b"([ \t\n\v\f\r")] = CLOSES[list(b")] \t\n\v\f\r")] = True


def with_trigger(texts: Texts) -> np.ndarray:
    """Texts with a digit or ``@``, or with the letters ``at`` between marks or spaces."""
    data = texts.data
    hot = TRIGGERS[data]
    if len(data) > 3:
        letters = (data[1:-2] | 0x20 == ord("a")) & (data[2:-1] | 0x20 == ord("t"))
        hot[1:-2] |= letters & OPENS[data[:-3]] & CLOSES[data[3:]]
    seen = np.concatenate([[0], np.cumsum(hot)])
    return seen[texts.offsets[1:]] > seen[texts.offsets[:-1]]


def all_spans(column: pa.Array, weights: dict) -> Iterator[tuple[str, list, list]]:
    """Text, base spans and added spans of every row."""
    for texts in slices(column):
        raw = texts.data.tobytes()
        for i, some in enumerate(with_trigger(texts).tolist()):
            if not some:
                yield "", [], []
                continue
            text = raw[texts.offsets[i] : texts.offsets[i + 1]].decode()
            base = base_spans(text)
            yield text, base, added_spans(text, base, weights)


def find(documents: DataFrame, weights: dict) -> DataFrame:
    """Counts and spans of every row; see ``SPANS``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, lists = [[] for _ in KINDS], [], []
            for _, base, added in all_spans(batch.column("text"), weights):
                for kind, out in enumerate(counts):
                    out.append(sum(k == kind for _, k, _ in base))
                digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                lists.append(written(sorted(base + added)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array(lists, pa.string())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, SPANS)


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every span replaced by its kind; spans that overlap an earlier one extend it."""
    out, done = [], 0
    for a, kind, b in sorted(spans):
        if a >= done:
            out += [text[done:a], f"<{KINDS[kind].upper()}>"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def masked(documents: DataFrame, weights: dict) -> DataFrame:
    """``documents`` with personal data replaced in ``text``; ``n_chars`` follows where it is there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in giving_back(batches):
            for first in range(0, whole.num_rows, ROWS):
                batch = whole.slice(first, ROWS)
                old, new = batch.column("text"), []
                for i, (text, base, added) in enumerate(all_spans(old, weights)):
                    new.append(mask(text, base + added) if base or added else old[i].as_py())
                yield batch.set_column(batch.schema.get_field_index("text"), "text", pa.array(new, pa.string()))

    out = documents.mapInArrow(run, documents.schema)
    if "n_chars" in documents.columns:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return out


def op9_personal(spark, sf_dir) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find(documents, fit(documents))
