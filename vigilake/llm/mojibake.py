"""Garbled text from wrong character encoding: find it, and restore it where it can still be known.

A hidden Markov model with one clean state and one state per *pair* (encoding of the bytes, encoding they were read
in) labels the characters of a value. Characters of a state's segments are emitted with the probability that the clean
model gives the character they stand for: a pair's forward transform of every clean character is its segment (``é`` is
``Ã©`` in the pair utf-8 read as cp1252), so all states share one table of counts, ``(character, left class, right
class)``, taken over the whole corpus. States persist (a value garbled once is garbled throughout), entering a pair
costs its prior. Viterbi gives the best path; each span labelled with a pair gets that pair's inverse transform.

ASCII has the same probability in the clean and in every pair state, so Viterbi steps from one non-ASCII run to the next;
the costs of a run in its context are kept per distinct run, which are few. Characters that were replaced by U+FFFD or question marks inside words are a state too (``lost``): it emits
these marks, which clean text hardly holds, and its inverse leaves them, so what else is garbled in the value is still restored. UTF-7 left undecoded is a state whose
segments are its shift sequences, and Shift-JIS, whose second bytes are ASCII, one that spans the whole value; both emit what they stand for with the clean model's counts.

The model that is broadcast holds counts per distinct character and context class: bounded by the alphabet, not by the rows.
"""

from __future__ import annotations

import base64
import html
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = ("title", "summary")
#: What a value must have to be worth a look: a character beyond ASCII, a question mark, a UTF-7 shift or an entity.
SUSPECT = r"[^\x00-\x7f]|\?|\+[A-Za-z0-9/]+-|&#?\w+;"
_RUN = re.compile(r"[^\x00-\x7f]+")
_BYTES = re.compile("[\x80-\x9f]|[‚ƒ][^ ]")
_UTF7 = re.compile(r"\+([A-Za-z0-9/]{3,})(?:-|(?![A-Za-z0-9/+]))")
_ASKED = re.compile(r"\S*\?\S*")
# Bytes that windows-1252 leaves open are read as control characters by browsers and feed readers.
_OPEN_1252 = {b: chr(b) for b in (0x81, 0x8D, 0x8F, 0x90, 0x9D)}

#: (name, encoding of the bytes, encoding they were read in, log prior of entering)
PAIRS = [
    ("utf8>cp1252", "utf-8", "cp1252", -5.5), ("utf8>latin1", "utf-8", "latin-1", -6.0), ("utf8>macroman", "utf-8", "mac_roman", -6.5),
    ("utf8>cp1251", "utf-8", "cp1251", -6.5), ("utf8>cp1250", "utf-8", "cp1250", -7.5), ("utf8>cp1254", "utf-8", "cp1254", -8.0), ("utf8>cp437", "utf-8", "cp437", -7.0),
    ("utf8>cp850", "utf-8", "cp850", -7.0), ("utf8>latin9", "utf-8", "iso8859-15", -8.0), ("utf8>koi8", "utf-8", "koi8-r", -8.0), ("utf8>cp866", "utf-8", "cp866", -8.0),
    ("utf8>sjis", "utf-8", "cp932", -8.0), ("utf8>gbk", "utf-8", "gbk", -8.0),
    ("cp1252>cp437", "cp1252", "cp437", -7.0), ("cp1252>cp850", "cp1252", "cp850", -9.5), ("cp1252>macroman", "cp1252", "mac_roman", -9.5), ("cp1252>cp1251", "cp1252", "cp1251", -9.5),
    ("cp1252>koi8", "cp1252", "koi8-r", -9.5), ("cp1252>cp866", "cp1252", "cp866", -9.5), ("macroman>cp1252", "mac_roman", "cp1252", -9.5), ("cp437>cp1252", "cp437", "cp1252", -9.5), ("cp850>cp1252", "cp850", "cp1252", -9.5),
]
LEAVE, MIXED, MARGIN = 1.0, 3.0, 0.5
#: States beside the pairs (-1 is clean), and their priors; what clean text costs that shows a mark of a loss in a word, or each character of a sequence that decodes as UTF-7.
LOST, UTF7, SHIFT_JIS = -2, -3, -4
BESIDE = {LOST: ("lost", -4.0), UTF7: ("utf7", -6.0), SHIFT_JIS: ("sjis", -8.0)}
LOST_MARK, CLEAN_ASKED, CLEAN_SHIFT = 1.0, 12.0, 3.0


def _read(raw: bytes, enc: str) -> str | None:
    try:
        return raw.decode(enc)
    except UnicodeDecodeError:
        if enc != "cp1252":
            return None
        return "".join(_OPEN_1252.get(b) or bytes([b]).decode("cp1252") for b in raw)


def _bytes(text: str, enc: str) -> bytes | None:
    try:
        return text.encode(enc)
    except UnicodeEncodeError:
        if enc != "cp1252":
            return None
        back = {v: k for k, v in _OPEN_1252.items()}
        try:
            return b"".join(bytes([back[c]]) if c in back else c.encode("cp1252") for c in text)
        except UnicodeEncodeError:
            return None


def garble(text: str, inside: str, outside: str) -> str | None:
    """``text`` as it looks when its bytes in ``inside`` are read as ``outside``; None if that can't be."""
    raw = _bytes(text, inside)
    return None if raw is None else _read(raw, outside)


def kind_of(c: str) -> str:
    """Context class: small or capital letter, digit, space (or an end), Japanese, mark."""
    if not c or c.isspace():
        return "s"
    if "　" <= c <= "鿿" or "＀" <= c <= "￯":
        return "j"
    return ("u" if c.isupper() else "l") if c.isalpha() else "d" if c.isdigit() else "p"


def _foreign(c: str) -> bool:
    """Characters that no language of the feeds is written with: their counts come from garbled values."""
    o = ord(c)
    return o < 0xA0 or o == 0xFFFD or 0x0370 <= o < 0x0590 and c not in "Ωμαβ" or 0x2500 <= o < 0x25A0 or 0x2200 <= o < 0x2300 or c in "ⁿ‡ƒ†‰√"


class Model:
    """Counts of characters in context, and what each pair makes of each character."""

    def __init__(self, counts: dict[tuple[str, str, str], int]):
        self.n = float(sum(counts.values())) or 1.0
        self.full, self.left, self.right, self.one, self.context = counts, Counter(), Counter(), Counter(), Counter()
        for (c, a, b), k in counts.items():
            self.left[c, a] += k
            self.right[c, b] += k
            self.one[c] += k
            self.context[a, b] += k
        self.segments: list[dict[str, list[str]]] = []
        self.names: list[str] = []
        self.priors: list[float] = []
        self.sizes: list[list[int]] = []
        alphabet = sorted(c for c in self.one if not _foreign(c)) or ["é"]

        def state(name: str, prior: float, image) -> None:
            table: dict[str, list[str]] = defaultdict(list)
            for c in alphabet:
                if (s := image(c)) and s != c and not s.isascii():
                    table[s].append(c)
                    if "\xa0" in s and s.strip("\xa0"):
                        table[s.replace("\xa0", " ")].append(c)
            if table:
                self.segments.append(dict(table))
                self.names.append(name)
                self.priors.append(prior)
                self.sizes.append(sorted({len(s) for s in table}, reverse=True))

        for name, inside, outside, prior in PAIRS:
            state(name, prior, lambda c, i=inside, o=outside: garble(c, i, o))
        for outside in ("cp1252", "latin-1"):
            once = lambda c, o=outside: garble(c, "utf-8", o)
            state(f"utf8>{outside} twice", -6.5, lambda c, f=once: (s := f(c)) and "".join(f(x) or "" for x in s))
            state(f"utf8>{outside} in lower case", -7.0, lambda c, f=once: (s := f(c)) and s.lower() if f(c) and f(c).lower() != f(c) else None)
            state(f"utf8>{outside} in upper case", -7.5, lambda c, f=once: (s := f(c)) and s.upper() if f(c) and f(c).upper() != f(c) else None)
            state(f"utf8>{outside} without controls", -7.0, lambda c, f=once: re.sub("[\x80-\x9f]", "", f(c) or ""))
        self.memo: dict[tuple[str, str, str], tuple[float, dict[int, tuple[float, str]]]] = {}

    def cost(self, c: str, a: str | None, b: str | None, clean: bool = True) -> float:
        """-log P(c | classes), interpolated with the bare frequency of ``c``."""
        if clean and _foreign(c):
            return 16.0
        bare = (self.one.get(c, 0) + 0.02) / self.n
        if a and b:
            near = self.full.get((c, a, b), 0) / (self.context.get((a, b), 0) + 1.0)
        elif a or b:
            near = (self.left.get((c, a), 0) if a else self.right.get((c, b), 0)) / (sum(v for (x, y), v in self.context.items() if (x == a if a else y == b)) + 1.0)
        else:
            near = bare
        return -math.log(0.995 * near + 0.005 * bare + 1e-9)

    def run(self, left: str, run: str, right: str) -> tuple[float, dict[int, tuple[float, str]]]:
        """Costs of a non-ASCII run: clean, and for each pair that can explain some of it (cost, restored run)."""
        key = (left, run, right)
        if key in self.memo:
            return self.memo[key]
        n = len(run)
        kinds = [left, *map(kind_of, run), right]
        single = [self.cost(c, kinds[i], kinds[i + 2]) for i, c in enumerate(run)]
        clean, out = sum(single), {}
        for k, table in enumerate(self.segments):
            best: list[tuple[float, str]] = [(0.0, "")] + [(math.inf, "")] * (n + 1)
            used = False
            for i in range(n):
                cost, text = best[i]
                if cost == math.inf:
                    continue
                if (x := cost + single[i] + MIXED) < best[i + 1][0]:
                    best[i + 1] = (x, text + run[i])
                for size in self.sizes[k]:
                    j = i + size
                    s = run[i:j] if j <= n else run[i:] + " " if j == n + 1 and right == "s" else None
                    for c in table.get(s, ()) if s else ():
                        a = kinds[0] if i == 0 else kind_of(text[-1:])
                        x = cost + self.cost(c, a, right if j >= n else None, False) + (1.0 if j > n else 0.0)
                        if x < best[j][0]:
                            best[j] = (x, text + c)
                            used = True
            end = min((best[n], "") , (best[n + 1], " "))  # " ": the run took the blank after it
            if used and end[0][0] < math.inf:
                out[k] = (end[0][0], end[0][1] + ("\0" if end[1] else ""))
        if len(self.memo) > 400_000:
            self.memo.clear()
        self.memo[key] = clean, out
        return clean, out

    def spans(self, text: str) -> list[tuple[int, int, float, dict[int, tuple[float, str]]]]:
        """(start, end, cost as clean, {state: (cost, restored)}) of all stretches that a state other than clean may have emitted, in order."""
        out = []
        for m in _RUN.finditer(text):
            clean, by = self.run(kind_of(text[m.start() - 1 : m.start()]), m.group(), kind_of(text[m.end() : m.end() + 1]))
            if "�" in m.group():
                # Pairs explain none of the lost characters, the lost state none of the others.
                by = by | {LOST: (sum(LOST_MARK if c == "�" else self.cost(c, None, None) for c in m.group()), m.group())}
            out.append((m.start(), m.end(), clean, by))
        if "?" in text:
            for m in _ASKED.finditer(text):
                if _lost(m.group()):
                    out += [(m.start() + x.start(), m.start() + x.end(), CLEAN_ASKED, {LOST: (LOST_MARK, x.group())}) for x in re.finditer(r"\?+", m.group())]
        if "+" in text:
            for m in _UTF7.finditer(text):
                if (s := self._shifted(m.group(1))) is not None:
                    out.append((m.start(), m.end(), CLEAN_SHIFT * len(m.group()), {UTF7: (sum(self.cost(c, None, None) for c in s if not c.isascii()), s)}))
        return sorted(out, key=lambda x: x[:2])

    def label(self, value: str) -> tuple[str, str | None] | None:
        """(state, restored text or None if nothing of it can be known) of a garbled value; None if the value is clean. Lost characters stay as they are in the restored text."""
        text = html.unescape(value) if "&" in value else value
        spans = self.spans(text)
        if not spans or all(cost >= clean for _, _, clean, by in spans for cost, _ in by.values()) and not _BYTES.search(text):
            return None
        # Viterbi over the spans; state -1 is clean, a span that a state can't explain costs it as clean text does.
        states = [-1, *sorted({k for *_, by in spans for k in by})]
        enter = {k: -(self.priors[k] if k >= 0 else BESIDE[k][1]) for k in states[1:]}
        score, back = {-1: 0.0} | enter, []
        for i, (_, _, clean, by) in enumerate(spans):
            emit = {k: by[k][0] if k in by and by[k][0] < clean + MIXED else clean + (MIXED if k != -1 else 0.0) for k in states}
            if i:
                low = min(states, key=score.__getitem__)
                arrive = {k: min((score[k], k), (score[low] + (LEAVE if k == -1 else enter[k]), low)) for k in states}
            else:
                arrive = {k: (score[k], k) for k in states}
            back.append({k: a[1] for k, a in arrive.items()})
            score = {k: arrive[k][0] + emit[k] for k in states}
        k = min(states, key=score.__getitem__)
        best, total, path = score[k], sum(clean for _, _, clean, _ in spans), [k]
        if (whole := self._shift_jis(text)) and sum(min(self.cost(c, None, None), 8.0) for c in whole if not c.isascii()) - BESIDE[SHIFT_JIS][1] < min(best, total - MARGIN):
            return "sjis", whole
        for b in reversed(back[1:]):
            path.append(k := b[k])
        path.reverse()
        if all(k == -1 for k in path) or best > total - MARGIN:
            return None
        out, at, known = [], 0, False
        for (start, end, _, by), k in zip(spans, path, strict=True):
            if start < at:  # a shift sequence within what was taken already
                continue
            out.append(text[at:start])
            new = by[k][1] if k != -1 and k in by else text[start:end]
            at = end + new.endswith("\0")
            known |= k not in (-1, LOST) and k in by and not (k >= 0 and "without controls" in self.names[k])
            out.append(new.rstrip("\0"))
        out.append(text[at:])
        named = [k for k in path if k != -1]
        first = next((k for k in named if k >= 0), named[0])
        return self.names[first] if first >= 0 else BESIDE[first][0], "".join(out) if known else None

    def _shift_jis(self, text: str) -> str | None:
        """The Japanese text that was read byte by byte as a western encoding, if ``text`` is such."""
        if not re.search("[\x80-\x9f‚ƒŽ’‘“”•–—]", text) or re.search("[぀-ヿ一-鿿]", text):
            return None
        raw = "".join(c for c in text if c != "�")
        for outside in ("cp1252", "latin-1"):
            if (b := _bytes(raw, outside)) is not None:
                for inside in ("cp932", "euc_jp"):
                    back = b.decode(inside, "replace")
                    beyond = [c for c in back if not c.isascii()]
                    known = sum("　" <= c <= "ヿ" or "一" <= c <= "鿿" or "！" <= c <= "～" for c in beyond)
                    kana = sum("぀" <= c <= "ヿ" for c in beyond)
                    if len(beyond) >= 3 and known >= 0.9 * len(beyond) and kana >= 1 and (kana >= 0.25 * len(beyond) or "�" not in back):
                        return back
        return None

    def _shifted(self, body: str) -> str | None:
        """What a shift sequence of UTF-7 stands for; None if it is none: whole units of 16 bits, padded with zeros, of characters that the corpus is written with."""
        try:
            raw = base64.b64decode(body + "=" * (-len(body) % 4))
            bits = len(body) * 6 % 16
            if bits >= 6 or len(raw) < 2 or (bits and "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/".index(body[-1]) & ((1 << bits) - 1)):
                return None
            out = raw[: len(raw) // 2 * 2].decode("utf-16-be")
        except (ValueError, UnicodeDecodeError):
            return None
        known = all(self.one.get(c, 0) >= 1 and not _foreign(c) or c in " \n" or "぀" <= c <= "鿿" or "＀" <= c <= "￯" for c in out)
        return out if known and not out.isascii() else None


def _lost(token: str) -> bool:
    """A question mark where a character was: inside a word, before one, or several in a row; addresses are left alone."""
    if "/" in token or "=" in token:
        return False
    return bool(re.search(r"[^\W\d_]\?+[^\W\d_]|\?\?", token) or re.match(r"[“\"(\[«]*\?+\w", token))


def _is_utf8(run: str) -> bool:
    """Whether the run is valid UTF-8 in a single-byte encoding: text never is by chance, so it can't teach what is clean."""
    for outside in ("cp1252", "mac_roman", "cp1251", "cp437", "cp850"):
        for s in (run, run.replace("ã", "Ã").replace("â", "Â")):
            if len(s) > 1 and (raw := _bytes(s, outside)) is not None and _read(raw, "utf-8") is not None:
                return True
    return False


def counts(signals: DataFrame, key: str = "row_id") -> DataFrame:
    """``(c, l, r, n)``: how often each non-ASCII character occurs between the context classes, over all rows.

    Runs that are UTF-8 read wrongly are left out, so that the clean model isn't taught by what it should find.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for pdf in batches:
            for v in pdf["v"]:
                text = html.unescape(v) if "&" in v else v
                for m in _RUN.finditer(text):
                    i, j = m.span()
                    seen[text[i - 1 : i] if i else "", m.group(), text[j : j + 1]] += 1
        out: Counter = Counter()
        for (a, run, b), k in seen.items():
            if _is_utf8(run):
                continue
            kinds = [kind_of(a), *map(kind_of, run), kind_of(b)]
            for i, c in enumerate(run):
                out[c, kinds[i], kinds[i + 2]] += k
        yield pd.DataFrame([(*key, k) for key, k in out.items()], columns=["c", "l", "r", "n"])

    values = _values(signals, key).where(F.col("v").rlike(r"[^\x00-\x7f]|&#?\w+;")).select("v")
    return values.mapInPandas(count, "c string, l string, r string, n long").groupBy("c", "l", "r").agg(F.sum("n").alias("n"))


def _values(signals: DataFrame, key: str = "row_id") -> DataFrame:
    pair = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("v")) for f in FIELDS])
    return signals.select(key, *FIELDS).select(key, F.explode(pair).alias("x")).select(key, "x.field", "x.v").where(F.col("v").isNotNull())


def model(signals: DataFrame, key: str = "row_id") -> dict[tuple[str, str, str], int]:
    """The counts on the driver: one entry per distinct character and context, bounded by the alphabet (Unicode times 36)."""
    return {(r["c"], r["l"], r["r"]): r["n"] for r in counts(signals, key).collect()}


def labelled(signals: DataFrame, key: str = "row_id") -> DataFrame:
    """``(key, field, state, restored)`` of each garbled ``title`` or ``summary``; ``restored`` is null where it can't be known.

    Null, empty and pure ASCII values are clean unless they hold lost characters or undecoded UTF-7. Repeated rows each count.
    """
    known = signals.sparkSession.sparkContext.broadcast(model(signals, key))

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = Model(known.value)
        for pdf in batches:
            rows = [(k, f, *found) for k, f, v in zip(pdf[key], pdf["field"], pdf["v"], strict=True) if (found := m.label(v))]
            yield pd.DataFrame(rows, columns=[key, "field", "state", "restored"])

    kind = dict(signals.dtypes)[key]
    return _values(signals, key).where(F.col("v").rlike(SUSPECT)).mapInPandas(label, f"{key} {kind}, field string, state string, restored string")


def found(signals: DataFrame) -> DataFrame:
    """``(row_id, field)`` of each value of which at least one character is wrong."""
    return labelled(signals).select("row_id", "field")
