"""Personal data in text by a semi-Markov conditional random field.

A zone is a stretch of text around numbers or an at sign, cut into atoms: runs of digits,
runs of letters, single other characters. A segmentation of a zone gives some spans of
atoms a kind and leaves the others outside; its score is the sum of the weights of
whole-span features (digits and groups, separators, checksum, what stands left and right,
cue words) and of kinds that follow each other. P(segmentation) is exp(score) over the sum
for all segmentations. Spans are bounded (groups, digits, pieces of a name), so dynamic
programming over the atoms finds the best segmentation, boundaries and kinds at once, in time linear
in the text.

Base spans follow fixed patterns; they are segments that every segmentation must hold, and
nothing else may overlap them. The field adds what the patterns miss: numbers that run into
each other, phone numbers without a plus sign after a cue word, addresses that write out
their at sign or dots.

The weights are fitted here on a bounded sample: base spans of the corpus, the same
rewritten in ways the patterns do not know, and examples made by rule.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from .common import as_texts, with_columns

KINDS = ("email", "ip", "card", "phone")
#: Bounds of the sample the field is fitted on: rows of the corpus, and their zones.
MAX_ROWS, MAX_ZONES = 10_000, 4_000
#: Characters kept left and right of a sampled zone, and the longest zone that is sampled.
LEFT, RIGHT, LONGEST = 40, 20, 200
#: Bounds of a span that the field adds: groups of digits, pieces of a local part, labels of a host.
MAX_GROUPS, MAX_PIECES, MAX_LABELS = 8, 4, 6
#: The longest local part and host of an address, as the standard has it.
MAX_LOCAL, MAX_HOST = 64, 255
STEPS, L2 = 60, 2e-3

# Words that announce a phone number, in the corpus' languages.
CUES = frozenset(
    "tel telephone phone call mobile cell fax telefon handy mobil anruf téléphone telefone portable appelez teléfono móvil llame".split()
)

# Patterns of the base spans. Possessive repeats and the look behind change no match: a
# match starts at the first digit of its run and takes whole runs.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_DIGITS = re.compile(r"[0-9]++")

_CHAIN = re.compile(r"[0-9]++(?:[ .()/-]{1,2}[0-9]++)*+")
_AT = re.compile(r"@|[\[(]at[\])]| at ")
_DOTTED = re.compile(r" ?[A-Za-z0-9-]++(?:(?:\.|[\[(]dot[\])]| dot | ?[\[(]dot[\])] ?)[A-Za-z0-9-]++)++")
_DOT = re.compile(r" ?[\[(]dot[\])] ?| dot |\.")
_ATOM = re.compile(r"[0-9]++|[A-Za-z]++|.", re.DOTALL)
_WORD = re.compile(r"[^\W\d_]++")
_SEPARATOR = frozenset(" .()/-+")

Span = tuple[str, int, int]

SPAN = StructType(
    [StructField("kind", StringType()), StructField("start", LongType()), StructField("end", LongType()), StructField("base", BooleanType())]
)


# --- base spans -----------------------------------------------------------------------


def passes_luhn(digits: str) -> bool:
    total = 0
    for at, digit in enumerate(reversed(digits)):
        value = ord(digit) - 48
        total += value if at % 2 == 0 else 2 * value - 9 * (value > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost addresses, found from their at signs: a local part never holds one."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and _LOCAL.match(text, start - 1):
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
            end = host.end()
        else:
            # What was read stays unread by others: the next local part starts after this at sign.
            end = at + 1
        at = text.find("@", end)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start, then kind as listed; matches that fail their check are dropped."""
    found: list[Span] = [("email", start, end) for start, end in _emails(text)]
    if _DIGITS.search(text):
        for match in _IP.finditer(text):
            parts = [part.lstrip("0") or "0" for part in match.group().split(".")]
            if all(len(part) <= 3 and int(part) <= 255 for part in parts):
                found.append(("ip", *match.span()))
        for match in _CARD.finditer(text):
            digits = match.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and passes_luhn(digits):
                found.append(("card", *match.span()))
        for match in _PHONE.finditer(text):
            if 9 <= sum(map(len, _DIGITS.findall(match.group()))) <= 15:
                found.append(("phone", *match.span()))
    return in_order(found)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# --- zones and candidates -------------------------------------------------------------


@dataclass
class Zone:
    """Atoms of a stretch of text and its candidate segments: (first atom, end atom, kind, features)."""

    atoms: list[tuple[int, int]]
    segments: list[tuple[int, int, int, tuple[str, ...]]]
    #: Whether an atom outside all spans keeps in mind which kind came before it.
    passing: list[bool] = field(default_factory=list)


def _local_starts(text: str, at: int) -> list[int]:
    """Where a local part that ends at ``at`` may start: at its beginning or after a dot."""
    start = at
    while start > 0 and at - start < MAX_LOCAL and _LOCAL.match(text, start - 1):
        start -= 1
    cuts = [start] + [i + 1 for i in range(start, at - 1) if text[i] == "."]
    return cuts[-MAX_PIECES:] if start < at else []


def _addresses(text: str) -> Iterator[tuple[int, int, int, list[int], list[int]]]:
    """(start, at, host, starts, ends) of what may be an address, at sign or not."""
    for sign in _AT.finditer(text):
        at = sign.start()
        if at and text[at - 1] == " " and sign.group() != " at ":
            at -= 1
        starts = _local_starts(text, at)
        # Every repeat of the pattern is possessive and the host is bounded: linear in the text.
        host = _DOTTED.match(text, sign.end(), sign.end() + MAX_HOST) if starts else None
        if host:
            ends = [dot.start() for dot in _DOT.finditer(text, host.start(), host.end())][1:] + [host.end()]
            yield starts[0], at, host.start(), starts, ends[:MAX_LABELS]


def zones(text: str, base: list[Span]) -> list[tuple[int, int]]:
    """Stretches that hold numbers of seven digits or more, addresses or base spans; none overlap."""
    found = [(start, end) for _, start, end in base]
    for match in _CHAIN.finditer(text):
        start, end = match.span()
        if end - start >= 7:
            while start and match.start() - start < 2 and text[start - 1] in "+(":
                start -= 1
            found.append((start, end))
    found += [(start, ends[-1]) for start, _, _, _, ends in _addresses(text)]
    merged: list[tuple[int, int]] = []
    for start, end in sorted(found):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


def _beside(text: str, at: int, step: int) -> str:
    """What stands beside a border: ``^`` nothing, ``a`` a letter, ``9`` a digit, else the character; ``+9`` if a digit follows it."""
    if not 0 <= at < len(text):
        return "^"
    char = text[at]
    if char.isdigit():
        return "9"
    if char.isalpha():
        return "a"
    far = at + step
    return (char if char < "\x7f" else "?") + ("9" if char in _SEPARATOR and 0 <= far < len(text) and text[far].isdigit() else "")


def _cued(text: str, start: int) -> bool:
    """Whether one of the three words before is a cue."""
    return any(word.lower() in CUES for word in _WORD.findall(text, max(0, start - LEFT), start)[-3:])


def _number_segments(text: str, low: int, high: int) -> Iterator[tuple[int, int, int, tuple[str, ...]]]:
    """Candidates made of digit groups, as (start, end, kind, features)."""
    groups = [match.span() for match in _DIGITS.finditer(text, low, high)]
    for i, (start, _) in enumerate(groups):
        digits, separators = "", []
        for j in range(i, min(len(groups), i + MAX_GROUPS)):
            if j > i:
                between = text[groups[j - 1][1] : groups[j][0]]
                if len(between) > 2 or not _SEPARATOR.issuperset(between) or "+" in between:
                    break
                separators.append(between)
            end = groups[j][1]
            digits += text[groups[j][0] : end]
            if len(digits) > 19:
                break
            ip = j - i == 3 and separators == [".", ".", "."]
            if len(digits) < 7 and not ip:
                continue
            lead = ""
            while start - len(lead) > low and len(lead) < 2 and text[start - len(lead) - 1] in "+(":
                lead = text[start - len(lead) - 1] + lead
            sizes = [groups[k][1] - groups[k][0] for k in range(i, j + 1)]
            used = "".join(sorted(set("".join(separators))))
            right = _beside(text, end, 1)
            for kind in range(4):
                if kind == 1 and ip:
                    parts = all(int(text[a:b]) <= 255 for a, b in groups[i : j + 1])
                    own = (f"parts{parts}", f"zero{any(b - a > 1 and text[a] == '0' for a, b in groups[i : j + 1])}")
                elif kind == 2 and len(digits) >= 12:
                    form = "one" if len(sizes) == 1 else "fours" if set(sizes) == {4} else "other"
                    own = (f"luhn{passes_luhn(digits)}", f"form{form}", f"digits{len(digits)}", f"lead{lead}")
                elif kind == 3 and 7 <= len(digits) <= 15:
                    cue = _cued(text, start - len(lead))
                    plus = "+" in lead
                    own = (f"plus{plus}", f"cue{cue}", f"plus{plus}cue{cue}", f"digits{len(digits)}", f"zero{digits[0] == '0'}", f"last{sizes[-1]}")
                else:
                    continue
                begin = start - len(lead) if kind == 3 else start
                left = _beside(text, begin - 1, -1)
                name = KINDS[kind]
                shared = ("", f"groups{len(sizes)}", f"by{used}", f"left{left}", f"right{right}")
                yield begin, end, kind, tuple(f"{name}|{what}" for what in (*shared, *own))


def _address_segments(text: str, low: int, high: int) -> Iterator[tuple[int, int, int, tuple[str, ...]]]:
    for _, at, host, starts, ends in _addresses(text[:high]):
        if at < low:
            continue
        sign = text[at:host]
        for start in starts:
            for end in ends:
                said = text[host:end]
                last = re.split(r"[^A-Za-z0-9-]", said)[-1]
                how, dots = sign.strip(), f"{'.' in said}{' dot ' in said}"
                features = (
                    "", f"sign{how}", f"dot{dots}", f"sign{how}dot{dots}", f"last{last.isalpha()}{min(len(last), 7)}",
                    f"whole{start == starts[0]}{end == ends[-1]}", f"left{_beside(text, start - 1, -1)}", f"right{_beside(text, end, 1)}",
                )
                yield start, end, 0, tuple(f"email|{what}" for what in features)


def zone_at(text: str, low: int, high: int) -> Zone:
    """Atoms and candidates of one zone."""
    # Candidates look at what stands around the zone, never further than a cue or a bounded part.
    left = max(0, low - MAX_LOCAL - MAX_HOST)
    near, shift = text[left : high + 2], left
    atoms = [match.span() for match in _ATOM.finditer(text, low, high)]
    first = {start: n for n, (start, _) in enumerate(atoms)}
    last = {end: n + 1 for n, (_, end) in enumerate(atoms)}
    segments = []
    made = [*_number_segments(near, low - shift, high - shift), *_address_segments(near, low - shift, high - shift)]
    for start, end, kind, features in made:
        i, j = first.get(start + shift), last.get(end + shift)
        if i is not None and j is not None:
            segments.append((i, j, kind, features))
    passing = [b - a == 1 and not text[a].isalnum() for a, b in atoms]
    return Zone(atoms, segments, passing)


# --- the field ------------------------------------------------------------------------

_NONE = -math.inf


def _lse(values: list[float]) -> float:
    top = max(values)
    return top if top == _NONE else top + math.log(sum(math.exp(v - top) for v in values))


@dataclass
class Field:
    """Weights of features, and of a kind (row, 4 = none) after which another kind follows in a zone."""

    weights: dict[str, float]
    follows: list[list[float]]

    def scores(self, zone: Zone) -> list[float]:
        get = self.weights.get
        return [sum([get(name, 0.0) for name in features]) for _, _, _, features in zone.segments]

    def best(self, zone: Zone, forced: dict[int, float] | None = None) -> list[int]:
        """Indices of the segments of the best segmentation, in order.

        The state after an atom is the kind of the last span of the zone, or none after a
        run of letters or digits outside all spans. ``forced`` adds to the scores of segments.
        """
        scores = self.scores(zone)
        for index, bonus in (forced or {}).items():
            scores[index] += bonus
        ending: dict[int, list[int]] = {}
        for index, segment in enumerate(zone.segments):
            ending.setdefault(segment[1], []).append(index)
        values = [[_NONE, _NONE, _NONE, _NONE, 0.0]]
        trace: list[list[tuple[int, int, int] | None]] = [[None] * 5]
        for at in range(1, len(zone.atoms) + 1):
            before = values[at - 1]
            if zone.passing[at - 1]:
                now, back = list(before), [(at - 1, state, -1) for state in range(5)]
            else:
                state = max(range(5), key=before.__getitem__)
                now, back = [_NONE] * 4 + [before[state]], [None] * 4 + [(at - 1, state, -1)]
            for index in ending.get(at, ()):
                i, _, kind, _ = zone.segments[index]
                state = max(range(5), key=lambda s: values[i][s] + self.follows[s][kind])
                value = values[i][state] + self.follows[state][kind] + scores[index]
                if value > now[kind]:
                    now[kind], back[kind] = value, (i, state, index)
            values.append(now)
            trace.append(back)
        at, state, chosen = len(zone.atoms), max(range(5), key=values[-1].__getitem__), []
        while trace[at][state]:
            at, state, index = trace[at][state]
            if index >= 0:
                chosen.append(index)
        return chosen[::-1]

    def expected(self, zone: Zone) -> tuple[float, list[float], list[list[float]]]:
        """log of the sum over all segmentations, the chance of each segment, the expected uses of ``follows``."""
        scores, n = self.scores(zone), len(zone.atoms)
        ending: dict[int, list[int]] = {}
        for index, segment in enumerate(zone.segments):
            ending.setdefault(segment[1], []).append(index)
        ahead = [[_NONE] * 5 for _ in range(n + 1)]
        ahead[0][4] = 0.0
        for at in range(1, n + 1):
            terms: list[list[float]] = [[] for _ in range(5)]
            for state in range(5):
                terms[state if zone.passing[at - 1] else 4].append(ahead[at - 1][state])
            for index in ending.get(at, ()):
                i, _, kind, _ = zone.segments[index]
                terms[kind] += [ahead[i][s] + self.follows[s][kind] + scores[index] for s in range(5)]
            ahead[at] = [_lse(t) if t else _NONE for t in terms]
        rest = [[_NONE] * 5 for _ in range(n + 1)]
        rest[n] = [0.0] * 5
        starting: dict[int, list[int]] = {}
        for index, segment in enumerate(zone.segments):
            starting.setdefault(segment[0], []).append(index)
        for at in range(n - 1, -1, -1):
            for state in range(5):
                terms_ = [rest[at + 1][state if zone.passing[at] else 4]]
                for index in starting.get(at, ()):
                    _, j, kind, _ = zone.segments[index]
                    terms_.append(self.follows[state][kind] + scores[index] + rest[j][kind])
                rest[at][state] = _lse(terms_)
        total = rest[0][4]
        chances, uses = [], [[0.0] * 4 for _ in range(5)]
        for index, (i, j, kind, _) in enumerate(zone.segments):
            chance = 0.0
            for state in range(5):
                if ahead[i][state] > _NONE:
                    part = math.exp(ahead[i][state] + self.follows[state][kind] + scores[index] + rest[j][kind] - total)
                    uses[state][kind] += part
                    chance += part
            chances.append(chance)
        return total, chances, uses

    def score_of(self, zone: Zone, chosen: list[int]) -> tuple[float, list[tuple[int, int]]]:
        """The score of one segmentation, and its uses of ``follows``."""
        scores, state, at, total, uses = self.scores(zone), 4, 0, 0.0, []
        for index in chosen:
            i, j, kind, _ = zone.segments[index]
            if not all(zone.passing[at:i]):
                state = 4
            total += scores[index] + self.follows[state][kind]
            uses.append((state, kind))
            state, at = kind, j
        return total, uses


Example = tuple[str, list[Span]]


def labelled(text: str, gold: list[Span]) -> list[tuple[Zone, list[int]]]:
    """Zones of an example with the segments that are right; a zone whose spans are no candidates is left out."""
    out = []
    for low, high in zones(text, gold):
        zone = zone_at(text, low, high)
        if not zone.segments:
            continue
        places = {(zone.atoms[i][0], zone.atoms[j - 1][1], kind): n for n, (i, j, kind, _) in enumerate(zone.segments)}
        right = [places.get((start, end, KINDS.index(kind))) for kind, start, end in gold if low <= start and end <= high]
        if None not in right:
            out.append((zone, right))
    return out


def objective(field_: Field, data: list[tuple[Zone, list[int]]]) -> tuple[float, dict[str, float], list[list[float]]]:
    """Mean log-likelihood, less the penalty, and its slopes."""
    slopes: dict[str, float] = {}
    moves = [[0.0] * 4 for _ in range(5)]
    value = 0.0
    for zone, right in data:
        total, chances, uses = field_.expected(zone)
        score, taken = field_.score_of(zone, right)
        value += score - total
        hits = set(right)
        for index, (chance, segment) in enumerate(zip(chances, zone.segments, strict=True)):
            change = (index in hits) - chance
            if abs(change) > 1e-12:
                for name in segment[3]:
                    slopes[name] = slopes.get(name, 0.0) + change
        for state, kind in taken:
            moves[state][kind] += 1
        for state in range(5):
            for kind in range(4):
                moves[state][kind] -= uses[state][kind]
    n = max(1, len(data))
    weights = field_.weights
    slopes = {name: slopes.get(name, 0.0) / n - L2 * weights.get(name, 0.0) for name in slopes.keys() | weights.keys()}
    moves = [[m / n - L2 * f for m, f in zip(a, b, strict=True)] for a, b in zip(moves, field_.follows, strict=True)]
    # A span after none has no weight of its own.
    moves[4] = [0.0] * 4
    penalty = sum(w * w for w in weights.values()) + sum(f * f for row in field_.follows for f in row)
    return value / n - L2 / 2 * penalty, slopes, moves


def fit(examples: list[Example], steps: int = STEPS, rate: float = 0.3) -> Field:
    """Maximum likelihood by gradient ascent (Adam), in a fixed order."""
    data = [pair for text, gold in examples for pair in labelled(text, gold)]
    field_ = Field({}, [[0.0] * 4 for _ in range(5)])
    moments: dict = {}
    for step in range(1, steps + 1):
        _, slopes, moves = objective(field_, data)
        named = [*slopes.items(), *[((s, k), moves[s][k]) for s in range(4) for k in range(4)]]
        for name, slope in named:
            mean, square = moments.get(name, (0.0, 0.0))
            mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
            moments[name] = mean, square
            change = rate * (1 - step / (steps + 1)) * (mean / (1 - 0.9**step)) / (math.sqrt(square / (1 - 0.99**step)) + 1e-8)
            if isinstance(name, str):
                field_.weights[name] = field_.weights.get(name, 0.0) + change
            else:
                field_.follows[name[0]][name[1]] += change
    return field_


# --- examples -------------------------------------------------------------------------


def apart(spans: list[Span]) -> list[Span]:
    """Of spans that overlap the longest stays, of equally long ones the first."""
    kept: list[Span] = []
    for span in sorted(spans, key=lambda s: (s[1] - s[2], s[1], KINDS.index(s[0]))):
        if all(span[2] <= other[1] or other[2] <= span[1] for other in kept):
            kept.append(span)
    return in_order(kept)


def _put(text: str, span: Span, said: str, kind: str | None, before: str = "", after: str = "") -> Example:
    """``text`` with another writing of a span, which is now the only one or none."""
    _, start, end = span
    at = start + len(before)
    return text[:start] + before + said + after + text[end:], [(kind, at, at + len(said))] if kind else []


def rewritten(text: str, span: Span, rng: random.Random) -> Iterator[Example]:
    """A span written in ways that the base patterns do not know, and ways that make it none."""
    kind, start, end = span
    said = text[start:end]
    some = "".join(rng.choices("0123456789", k=rng.choice((3, 4, 5, 16))))
    if kind == "phone":
        bare = said.lstrip("+(")
        yield _put(text, span, bare, "phone", before=rng.choice(sorted(CUES)) + rng.choice((" ", ": ", ". ")))
        yield _put(text, span, bare, None)
        other = ".".join(str(rng.randrange(256)) for _ in range(4))
        joined, gold = _put(text, span, said, "phone", after=" " + other)
        yield joined, [*gold, ("ip", gold[0][2] + 1, gold[0][2] + 1 + len(other))]
    elif kind == "card":
        yield _put(text, span, said, "card", after=" " + some)
        yield _put(text, span, said, "card", before=some + " ")
        yield _put(text, span, said[:-1] + str((int(said[-1]) + rng.randrange(1, 10)) % 10), None)
    elif kind == "ip":
        yield _put(text, span, f"{rng.randrange(256, 1000)}{said[said.index('.') :]}", None)
        yield _put(text, span, said, "ip", before=some + " ")
    else:
        name, host = said.split("@")
        at, dot = rng.choice(((" at ", " dot "), ("(at)", "(dot)"), ("[at]", "."), (" (at) ", " (dot) "), (" @ ", ".")))
        yield _put(text, span, f"{name}{at}{host.replace('.', dot)}", "email")
        yield _put(text, span, f"{name} at {host}", None)


def made_examples(size: int = 60, seed: int = 0) -> list[Example]:
    """Examples by rule, so that a corpus with few or no spans gives a sound field too."""
    rng = random.Random(seed)
    digits = lambda n: "".join(rng.choices("0123456789", k=n))
    words = "report from here then order number page total about where under value".split()
    out: list[Example] = []
    for _ in range(size):
        card = digits(15)
        card += next(d for d in "0123456789" if passes_luhn(card + d))
        if rng.random() < 0.5:
            card = rng.choice(" -").join(card[i : i + 4] for i in range(0, 16, 4))
        phone = rng.choice((f"+{digits(2)} {digits(3)} {digits(4)}", f"+1 ({digits(3)}) {digits(3)}-{digits(4)}", f"+{digits(11)}"))
        host = f"{rng.choice(words)}{digits(1)}.example.{rng.choice(('com', 'org', 'de'))}"
        entities = (("email", f"{rng.choice(words)}.{digits(2)}@{host}"), ("ip", ".".join(str(rng.randrange(1, 256)) for _ in range(4))), ("card", card), ("phone", phone))
        for kind, said in entities:
            left, right = " ".join(rng.choices(words, k=4)) + rng.choice((" ", ": ")), rng.choice((" ", ". ", ", ", "\n")) + rng.choice(words)
            text = left + said + right
            gold = (kind, len(left), len(left) + len(said))
            out.append((text, [gold]))
            out.extend(rewritten(text, gold, rng))
        # Numbers that are none: dates, amounts, ids, versions.
        for said in (digits(rng.choice((7, 8, 9, 10, 11, 13, 17))), f"20{digits(2)}-0{1 + rng.randrange(9)}-1{rng.randrange(10)}", f"{digits(3)} {digits(3)} {digits(3)}", f"{digits(4)}-{digits(5)}"):
            left = " ".join(rng.choices(words, k=4)) + " "
            if not base_spans(left + said):
                out.append((left + said + " " + rng.choice(words), []))
    return out


def zone_examples(texts: list[str], seed: int = 1) -> list[Example]:
    """Sampled zones with their surroundings: their base spans are right, and so are rewritten ones."""
    rng = random.Random(seed)
    out: list[Example] = []
    for text in texts:
        gold = apart(base_spans(text))
        out.append((text, gold))
        if len(gold) == 1:
            out.extend(rewritten(text, gold[0], rng))
    return out


def sampled_zones(text: str) -> list[str]:
    base = base_spans(text)
    return [text[max(0, low - LEFT) : high + RIGHT] for low, high in zones(text, base) if high - low <= LONGEST]


def train(docs: DataFrame, max_rows: int = MAX_ROWS, max_zones: int = MAX_ZONES, text_col: str = "text") -> Field:
    """Fit on the zones of at most ``max_rows`` different texts, ``max_zones`` zones at most, chosen by hash."""
    mark = F.xxhash64(F.col(text_col)).alias("mark")
    spoken = docs.where(F.col(text_col).isNotNull())
    # The sample has at most max_rows marks of 8 bytes, so its broadcast is bounded.
    sample = spoken.select(mark).distinct().orderBy("mark").limit(max_rows)
    rows = spoken.select(mark, F.col(text_col).alias("text")).join(F.broadcast(sample), "mark").select("text")

    def make(batches: Iterator[dict]) -> Iterator[dict]:
        for batch in batches:
            yield {"zones": pa.array([sampled_zones(t) for t in as_texts(batch["text"])], pa.list_(pa.string()))}

    cut = with_columns(rows, ["text"], StructType([StructField("zones", ArrayType(StringType()))]), make)
    each = cut.select(F.explode("zones").alias("zone")).distinct()
    chosen = each.orderBy(F.xxhash64("zone"), "zone").limit(max_zones).collect()
    return fit(made_examples() + zone_examples([row.zone for row in chosen]))


# --- scanning -------------------------------------------------------------------------


def spans_of(text: str, field_: Field) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, base) of all spans of a text, by start, then kind as listed."""
    base = base_spans(text)
    found = {span: True for span in base}
    at = 0
    for low, high in zones(text, base):
        fixed = []
        while at < len(base) and base[at][1] < high:
            fixed.append(base[at])
            at += 1
        zone = zone_at(text, low, high)
        if fixed:
            zone = _with_fixed(zone, fixed)
        forced = {n: 1e6 for n, segment in enumerate(zone.segments) if not segment[3]}
        for index in field_.best(zone, forced) if zone.segments else ():
            i, j, kind, _ = zone.segments[index]
            found.setdefault((KINDS[kind], zone.atoms[i][0], zone.atoms[j - 1][1]), False)
    return [(*span, found[span]) for span in in_order(list(found))]


def _with_fixed(zone: Zone, fixed: list[Span]) -> Zone:
    """Base spans as segments without features; no other segment may overlap one."""
    first = {start: n for n, (start, _) in enumerate(zone.atoms)}
    last = {end: n + 1 for n, (_, end) in enumerate(zone.atoms)}
    taken = bytearray(len(zone.atoms) + 1)
    kept = []
    for kind, start, end in fixed:
        i, j = first[start], last[end]
        taken[i:j] = b"\x01" * (j - i)
        kept.append((i, j, KINDS.index(kind), ()))
    free = [segment for segment in zone.segments if 1 not in taken[segment[0] : segment[1]]]
    return Zone(zone.atoms, kept + free, zone.passing)


def scan(docs: DataFrame, field_: Field, text_col: str = "text") -> DataFrame:
    """Add ``found``: structs of kind, start, end (code points, end exclusive) and whether a base pattern says so.

    Base spans all stay, also where those of different kinds overlap; spans that the field
    adds overlap neither them nor each other. Null and empty texts have none. Each row is
    judged by its text alone, so repeated rows, ties, null ids and empty tables need no care.
    An input column of that name is replaced.
    """
    held = docs.sparkSession.sparkContext.broadcast(field_)

    def make(batches: Iterator[dict]) -> Iterator[dict]:
        field_ = held.value
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))
        for batch in batches:
            found = [[dict(zip(SPAN.names, span, strict=True)) for span in spans_of(t, field_)] for t in as_texts(batch[text_col])]
            yield {"found": pa.array(found, kind)}

    return with_columns(docs, [text_col], StructType([StructField("found", ArrayType(SPAN))]), make)


def written(found: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
