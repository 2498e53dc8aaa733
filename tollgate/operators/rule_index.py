"""An index from literals to rules, for rule tables of thousands of patterns.

A pattern can only match where its *required literal* stands: a run of plain
characters that every match holds.  :func:`required_literals` finds one for
each top-level alternative.  The index compares *squeezed* texts and literals
(:func:`squeezed`: repeats of a character are one), so that a repeated character
(``[ ]+``) does not cut a literal in two and ``alpha[ ]+beta`` is looked up by both
words.  All literals of a block of rules go into arrays (:class:`Literals`), made
once and sent to every task; one pass over the texts compares, many places at a
time, the hash of each place with that of the literals.  A pattern that is
nothing but plain and repeated characters (:func:`whole_runs`) is decided
there, by the lengths of the runs in the text; the text goes back to Spark only
with the few other patterns that may match, and these run there.  Rules alike in
pattern and hints are looked up and run once and told apart in the last join.

Rules without a literal of ``SHORTEST`` characters are not indexed and run on
every text: patterns that are only classes, groups, optional or very short
pieces, have an alternative of that kind, or use syntax the extraction does not
follow (flags other than i, m, s; quotes ``\\Q``; numeric and property escapes).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

SHORTEST = 3
#: Conditions of one block; a larger table takes as many passes over the texts.
BLOCK_RULES = 1_000_000
#: What makes rules alike.
CONDITION = ("pattern", "hints", "ci_hints", "hint_re")

_LOWER = {c: c + 32 for c in range(65, 91)}
_FLAGS = re.compile(r"\(\?([A-Za-z]+)\)")
_GROUP = re.compile(r"\?(:|=|!|>|<=|<!|<[A-Za-z][A-Za-z0-9]*>)")
_COUNT = re.compile(r"\{([0-9]+)(,[0-9]*)?\}")
#: A character (alone in a class, escaped or plain) and how often it stands.
_PIECE = re.compile(r"(?:\[([^\^\[\]\\&-])\]|\\([ -/:-@\[-`{-~])|([^\\\[\](){}.^$|*+?]))(?:(\+)|\{([0-9]+)(,?)([0-9]*)\})?(?![*+?{])")
#: What a literal found in a text says: its pattern may match, or it does (the
#: counts of its runs granted) in any case of letters, or as written.
MAYBE, SURE, CASED = 0, 1, 2
#: As a greatest count: any.
ANY = 255
#: Lengths of the windows that are hashed, each the sum of two before it.
WIDTHS = {1: (), 2: (1, 1), 3: (2, 1), 6: (3, 3), 9: (6, 3)}
#: Characters of the texts taken together, places hashed at a time, runs
#: compared at a time.
PIECE_CHARS, WINDOW, COMPARED = 1 << 18, 1 << 16, 1 << 20
_BASE, _ONE, _OTHER = 0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35
_LITERAL = "array<struct<chars: string, least: binary, most: binary, kind: int>>"


def folded(text: str) -> str:
    """A-Z in lower case, all else as it is (lengths and other letters stay)."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def squeezed(text: str) -> str:
    """:func:`folded`, and every run of one character as that character: if a
    text holds a literal, the squeezed text holds the squeezed literal."""
    code = np.frombuffer(folded(text).encode("utf-32-le", "surrogatepass"), np.uint32)
    keep = np.ones(len(code), bool)
    np.not_equal(code[1:], code[:-1], out=keep[1:])
    return code[keep].tobytes().decode("utf-32-le", "surrogatepass")


def _skip(p: str, i: int) -> int | None:
    """End of the class or group that opens at ``i``; None if it is not followed."""
    opens, depth, in_class = p[i], 0, 0
    while i < len(p):
        c = p[i]
        if c == "\\":
            if p[i + 1: i + 2] in ("Q", "E"):
                return None
            i += 2
            continue
        if c == "[":
            in_class += 1
        elif c == "]" and in_class:
            in_class -= 1
            if opens == "[" and not in_class:
                return i + 1
        elif c == "(" and not in_class:
            if p[i + 1: i + 2] == "?" and not _GROUP.match(p, i + 1):
                return None
            depth += 1
        elif c == ")" and not in_class:
            depth -= 1
            if not depth:
                return i + 1
        i += 1
    return None


def required_literals(pattern: str) -> tuple[str, ...] | None:
    """Literals, A-Z in lower case, one of which every match holds; None if no
    such set is found."""
    found = _alternatives(pattern)
    if found is None or min(map(len, found)) < SHORTEST:
        return None
    return tuple(sorted({folded(x) for x in found}))


def squeezed_literals(pattern: str) -> tuple[str, ...] | None:
    """As :func:`required_literals`, for squeezed texts: a literal goes on over a
    repeated character and over a class of one character."""
    found = _alternatives(pattern, joined=True)
    if found is None or min(map(len, found)) < SHORTEST and required_literals(pattern) is None:
        return None
    return tuple(sorted(set(found)))


def _alternatives(pattern: str, joined: bool = False) -> list[str] | None:
    """The longest run of plain characters of each top-level alternative; None
    if the pattern is not followed.  ``joined``: squeezed runs."""
    p, i = pattern, 0
    flags = _FLAGS.match(p)
    if flags:
        if set(flags[1]) - set("ims"):
            return None
        i = flags.end()
    found, runs, run, single = [], [], "", False  # single: the last atom is the run's last character

    def close() -> None:
        nonlocal run
        runs.append(squeezed(run) if joined else run)
        run = ""
    while i < len(p):
        c = p[i]
        quantifier = None
        if c == "\\":
            n = p[i + 1: i + 2]
            if not n or (n.isalnum() and n not in "dDwWsSbBhHvVRAzZGtnrfae"):
                return None
            if n.isalnum():
                close()
                single = False
            else:
                run, single = run + n, True
            i += 2
        elif joined and c == "[" and p[i + 2: i + 3] == "]" and p[i + 1] not in "^[]\\":
            run, i, single = run + p[i + 1], i + 3, True
        elif c in "[(":
            end = _skip(p, i)
            if end is None:
                return None
            close()
            i, single = end, False
        elif c in ".^$":
            close()
            i, single = i + 1, False
        elif c == "|":
            close()
            found.append(max(runs, key=len))
            runs, i, single = [], i + 1, False
        elif c in "*+?":
            quantifier, i = int(c == "+"), i + 1
        elif c == "{":
            count = _COUNT.match(p, i)
            if not count:
                return None
            quantifier, i = int(count[1]), count.end()
        elif c == ")":
            return None
        else:
            run, i, single = run + c, i + 1, True
        if quantifier is not None:
            if single and not quantifier:
                run = run[:-1]
            if not (joined and single and quantifier):
                close()
            single = False
            if p[i: i + 1] in ("?", "+") and p[i: i + 1]:
                i += 1
    close()
    found.append(max(runs, key=len))
    return found


def whole_runs(pattern: str) -> tuple[bool, list[list[tuple[str, int, int]]]] | None:
    """Whether A-Z and a-z are alike, and each top-level alternative as runs
    (character, least and greatest count, ``ANY`` for no end) if the pattern is
    nothing but these; else None.  Neighbours differ, also when folded; the
    first and the last run go on in the text as they like."""
    flags = _FLAGS.match(pattern)
    if flags and set(flags[1]) - set("ims"):
        return None
    any_case = bool(flags) and "i" in flags[1]
    i = flags.end() if flags else 0
    found: list[list] = [[]]
    while i < len(pattern):
        if pattern[i] == "|":
            found.append([])
            i += 1
            continue
        m = _PIECE.match(pattern, i)
        if not m:
            return None
        c, least, most = m[1] or m[2] or m[3], 1, 1.0
        if m[4] or m[5]:
            least = int(m[5] or 1)
            most = float(m[7] or ("inf" if m[4] or m[6] else least))
        if least < 1 or most < least:
            return None
        runs = found[-1]
        if runs and folded(runs[-1][0]) == folded(c):
            if not any_case and runs[-1][0] != c:
                return None
            _, x, y = runs.pop()
            least, most = least + x, most + y
        runs.append((folded(c) if any_case else c, least, most))
        i = m.end()
    for runs in found:
        if not runs or any(least >= ANY or ANY <= most < float("inf") for _, least, most in runs):
            return None
        runs[:] = [(c, least, ANY if k in (0, len(runs) - 1) or most >= ANY else int(most)) for k, (c, least, most) in enumerate(runs)]
    return any_case, found


def _described(pattern: str, hinted: bool) -> list[dict] | None:
    """The literals of a pattern with the counts of their runs."""
    whole = whole_runs(pattern)
    if whole is None or min(map(len, whole[1])) < SHORTEST:
        found = squeezed_literals(pattern)
        if found is None:
            return None
    if whole is None:
        return [{"chars": x, "least": b"\x01" * len(x), "most": bytes([ANY]) * len(x), "kind": MAYBE} for x in found]
    any_case, alternatives = whole
    kind = MAYBE if hinted else SURE if any_case else CASED
    out = [tuple(zip(*runs)) for runs in alternatives]
    return [{"chars": "".join(c), "least": bytes(least), "most": bytes(most), "kind": kind} for c, least, most in dict.fromkeys(out)]


def _literals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("chars", pa.string()), ("least", pa.binary()), ("most", pa.binary()), ("kind", pa.int32())]))
    for batch in batches:
        hints = zip(*(batch.column(c).to_pylist() for c in CONDITION[1:]))
        asked = [(p, bool(h or ci) or r is not None) for p, (h, ci, r) in zip(batch.column("pattern").to_pylist(), hints)]
        known = {x: _described(*x) for x in set(asked)}
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([known[x] for x in asked], kind)], [*batch.schema.names, "literals"])


def with_literals(rules: DataFrame) -> DataFrame:
    """``rules`` with the array column ``literals``, squeezed, with the counts of
    their runs (NULL: not indexed)."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rules.schema.fields)
    return rules.mapInArrow(_literals, f"{kinds}, literals {_LITERAL}")


def _lower(code: np.ndarray) -> np.ndarray:
    """:func:`folded`, of codes."""
    return code + ((code - np.uint32(65) < 26).astype(np.uint32) << np.uint32(5))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _hashes(chars: np.ndarray, widths: set[int]) -> dict[int, np.ndarray]:
    """For each width, the hash of as many characters from each place on, as far
    as there are so many."""
    need, out = set(widths), {1: chars}
    for w in sorted(WIDTHS, reverse=True):
        if w in need:
            need.update(WIDTHS[w])
    for w, parts in WIDTHS.items():
        if w in need and parts:
            a, b = parts
            n = max(0, len(chars) - w + 1)
            out[w] = out[a][:n] * np.uint32(pow(_BASE, b, 1 << 32)) + out[b][a:a + n]
    return {w: out[w] for w in widths}


def _slots(hashes: np.ndarray, bits: int, by: int = _ONE) -> np.ndarray:
    return ((hashes * np.uint32(by)) >> np.uint32(32 - bits)).astype(np.int64)


def _joined(values: pa.Array) -> tuple[bytes, np.ndarray]:
    """All bytes of strings, and the length of each in bytes."""
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset: values.offset + len(values) + 1] if len(values) else np.zeros(1, np.int32)
    data = values.buffers()[2]
    return data[int(ends[0]): int(ends[-1])].to_pybytes() if data is not None else b"", np.diff(ends)


def _spans(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of some spans one after another, and where each span begins
    among them."""
    begins = np.cumsum(lengths) - lengths
    return np.repeat(starts - begins, lengths) + np.arange(lengths.sum()), begins


class Literals:
    """The literals of a block of rules (:data:`_LITERAL`), in arrays: those of
    the rule ``ids[k]`` have ``rule`` k.  Each is found by the hash of one window
    of it (``anchor``, at ``shift``), the one that is rarest among the literals.
    Iterating gives each rule with its squeezed literals."""

    def __init__(self, rules: pa.Table):
        lists = rules.column("literals").combine_chunks()
        entries = lists.flatten()
        self.ids = rules.column("alike").to_numpy()
        self.rule = np.repeat(np.arange(len(lists), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
        self.code = _codes(_joined(entries.field("chars"))[0].decode())
        (least, length), (most, _) = (_joined(entries.field(c)) for c in ("least", "most"))
        self.length = length.astype(np.int64)
        self.least, self.most = np.frombuffer(least, np.uint8), np.frombuffer(most, np.uint8)
        self.kind = entries.field("kind").to_numpy().astype(np.uint8)
        self._anchor()

    def __len__(self) -> int:
        return len(self.ids)

    def __iter__(self) -> Iterator[tuple[int, tuple[str, ...]]]:
        of: list[list[str]] = [[] for _ in self.ids]
        chars = _lower(self.code).tobytes().decode("utf-32-le", "surrogatepass")
        for rule, start, n in zip(self.rule.tolist(), self.start.tolist(), self.length.tolist()):
            of[rule].append(chars[start:start + n])
        return zip(self.ids.tolist(), map(tuple, of))

    def _anchor(self) -> None:
        self.start = np.cumsum(self.length) - self.length
        widths = np.array(sorted(WIDTHS))
        self.width = widths[np.searchsorted(widths, self.length, "right") - 1].astype(np.uint8)
        n = len(self.length)
        self.shift, self.anchor = np.zeros(n, np.int64), np.zeros(n, np.uint32)
        for w in map(int, np.unique(self.width)):
            these = np.flatnonzero(self.width == w)
            parts = np.array_split(these, max(1, len(these) >> 16))
            seen = np.zeros(1 << 22, np.int64)
            for part in parts:
                seen += np.bincount(_slots(self._windows(part, w)[0], 22), minlength=1 << 22)
            for part in parts:
                hashes, begins = self._windows(part, w)
                at = np.arange(len(hashes))
                rarest = np.minimum.reduceat((seen[_slots(hashes, 22)] << 32) + at, begins) & 0xFFFFFFFF
                self.shift[part], self.anchor[part] = rarest - begins, hashes[rarest]
        order = np.lexsort((self.anchor, self.width))
        for name in ("rule", "kind", "start", "length", "width", "shift", "anchor"):
            setattr(self, name, getattr(self, name)[order])
        self.length, self.shift = self.length.astype(np.int32), self.shift.astype(np.int32)

    def _windows(self, entries: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all windows of some entries, and where each entry's begin."""
        places, begins = _spans(self.start[entries], self.length[entries])
        hashes = _hashes(_lower(self.code[places]), {w})[w]
        return hashes[_spans(begins, self.length[entries] - w + 1)[0]], np.cumsum(self.length[entries] - w + 1) - (self.length[entries] - w + 1)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_tables"}

    def tables(self) -> dict[int, tuple]:
        """By width: the hashes and where their literals begin and end, and a
        table that most hashes of other windows are not in."""
        if "_tables" not in self.__dict__:
            self._tables = {}
            for w in map(int, np.unique(self.width)):
                a, b = np.searchsorted(self.width, [w, w + 1])
                keys, first = np.unique(self.anchor[a:b], return_index=True)
                bits = max(12, int(len(keys) * 16).bit_length())
                some = np.zeros(1 << bits, bool)
                some[_slots(keys, bits)] = some[_slots(keys, bits, _OTHER)] = True
                self._tables[w] = keys, np.append(first + a, b), bits, some
        return self._tables

    def found(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, rule and whether the rule matches for sure, for each text and
        rule that may match, in this order."""
        ends = np.cumsum([len(t or "") for t in texts])
        code = _codes("".join(t or "" for t in texts))
        none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        if not len(code) or not len(self.rule):
            return none
        low = _lower(code)
        keep = np.ones(len(code), bool)
        np.not_equal(low[1:], low[:-1], out=keep[1:])
        keep[ends[ends < len(code)]] = True
        at = np.append(np.flatnonzero(keep), len(code))
        chars = low[at[:-1]]
        mixed = np.zeros(len(chars), bool)  # runs of letters of both cases
        if CASED in self.kind:
            mixed[np.searchsorted(at, np.flatnonzero((code[1:] != code[:-1]) & ~keep[1:]) + 1, "right") - 1] = True
        tables, widest = self.tables(), max(self.tables())
        places, firsts, manys = [], [], []
        for p in range(0, len(chars), WINDOW):
            hashes = _hashes(chars[p: p + WINDOW + widest - 1], set(tables))
            for w, (keys, first, bits, some) in tables.items():
                h = hashes[w][:WINDOW]
                near = np.flatnonzero(some[_slots(h, bits)])
                h = h[near]
                near, h = (x[some[_slots(h, bits, _OTHER)]] for x in (near, h))
                key = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                same = keys[key] == h
                key = key[same]
                places.append(near[same] + p)
                firsts.append(first[key])
                manys.append(first[key + 1] - first[key])
        near, first, many = map(np.concatenate, (places, firsts, manys))
        parts = []
        for a, b in _parts(many, COMPARED >> 4):  # one place may have many literals
            entry = _spans(first[a:b], many[a:b])[0]
            begin = np.repeat(near[a:b], many[a:b]) - self.shift[entry]
            inside = (begin >= 0) & (begin + self.length[entry] <= len(chars))
            begin, entry = begin[inside], entry[inside]
            last = self.length[entry] - 1
            ends_alike = (chars[begin] == _lower(self.code[self.start[entry]])) & (chars[begin + last] == _lower(self.code[self.start[entry] + last]))
            begin, entry = begin[ends_alike], entry[ends_alike]  # few are left
            parts.extend(self._held(code, at, chars, mixed, ends, begin[c:d], entry[c:d]) for c, d in _parts(self.length[entry], COMPARED))
        if not parts:
            return none
        text, rule, sure = map(np.concatenate, zip(*parts))
        order = np.lexsort((~sure, rule, text))
        text, rule, sure = text[order], rule[order], sure[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (rule[1:] != rule[:-1])
        return text[new], rule[new], sure[new]

    def _held(self, code, at, chars, mixed, ends, begin, entry) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        def spread(begin, entry):
            run, begins = _spans(begin, self.length[entry])
            return run, _spans(self.start[entry], self.length[entry])[0], begins

        run, char, begins = spread(begin, entry)
        text = np.searchsorted(ends, at[begin], "right")
        held = np.logical_and.reduceat(chars[run] == _lower(self.code[char]), begins) & (at[begin + self.length[entry]] <= ends[text])
        begin, entry, text = begin[held], entry[held], text[held]
        if not len(entry):
            return text, entry, held[held]
        run, char, begins = spread(begin, entry)
        kind = self.kind[entry]
        count, most = at[run + 1] - at[run], self.most[char]
        counted = np.logical_and.reduceat((count >= self.least[char]) & ((most == ANY) | (count <= most)), begins)
        written = np.logical_and.reduceat(code[at[run]] == self.code[char], begins)
        unclear = np.logical_or.reduceat(mixed[run], begins) & (kind == CASED)
        held = (kind == MAYBE) | counted & ((kind == SURE) | written | unclear)
        return text[held], self.rule[entry[held]].astype(np.int64), ((kind != MAYBE) & ~unclear)[held]


def _parts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of entries of about ``most`` together, one at least."""
    ends = np.cumsum(sizes)
    a = 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        yield a, b
        a = b


def _pieces(lengths: list[int]) -> Iterator[tuple[int, int]]:
    return _parts(np.array(lengths, np.int64), PIECE_CHARS)


def _candidates(literals_ref) -> Callable:
    """For each text, the rules that match (without the text), and the rules that
    may (with the text)."""
    def rows(batch: pa.RecordBatch, text, rule, with_text: bool) -> pa.RecordBatch:
        k, begins = np.unique(text, return_index=True)
        kept = batch.take(pa.array(k, pa.int64()))
        rules = pa.ListArray.from_arrays(pa.array(np.append(begins, len(rule)), pa.int32()), pa.array(rule, pa.int64()))
        texts = kept.column(1) if with_text else pa.nulls(len(k), pa.string())
        return pa.RecordBatch.from_arrays([kept.column(0), texts, rules], [*batch.schema.names[:2], "rules"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        literals = literals_ref.value
        for batch in batches:
            for a, b in _pieces(pc.utf8_length(pc.fill_null(batch.column(1), "")).to_pylist()):
                piece = batch.slice(a, b - a)
                text, rule, sure = literals.found(piece.column(1).to_pylist())
                for these in (sure, ~sure):
                    if these.any():
                        yield rows(piece, text[these], literals.ids[rule[these]], these is not sure)
    return run


def _passes_hints() -> Column:
    """A rule's hints, where it has some: one of them holds of the text."""
    text = F.col("text")
    some = F.exists("hints", lambda h: F.contains(text, h)), F.exists("ci_hints", lambda h: F.contains(F.lower(text), h)), F.expr("rlike(text, hint_re)")
    none = (F.coalesce(F.size("hints"), F.lit(0)) <= 0) & (F.coalesce(F.size("ci_hints"), F.lit(0)) <= 0) & F.col("hint_re").isNull()
    held = F.lit(False)
    for h in some:
        held = held | F.coalesce(h, F.lit(False))
    return none | held


def indexed_matches(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows (item_id, and the columns of the rule that are neither its condition
    nor its literals) for each text (item_id, text) and rule (rule_id, pattern,
    literals, hints, ci_hints, hint_re and others) that match.  Each block of
    about ``BLOCK_RULES`` conditions is one pass over the texts; a block's literals
    are read to the driver and broadcast, never the whole table.  Alike rules
    are in one block and go by the least rule_id among them."""
    spark = texts.sparkSession
    kind = texts.schema["item_id"].dataType.simpleString()
    path = scratch_path(spark, "rules-alike")  # written: alike rules are found once, however often they are read
    rules.withColumn("alike", F.min("rule_id").over(Window.partitionBy(*CONDITION))).write.parquet(path)
    rules = spark.read.parquet(path)
    rest = [c for c in rules.columns if c not in (*CONDITION, "literals")]
    blocks = max(1, -(-rules.where("rule_id = alike").count() // BLOCK_RULES))
    out = None
    for b in range(blocks):
        block = rules.where(F.pmod(F.xxhash64("pattern"), F.lit(blocks)) == b)
        once = block.where("rule_id = alike")
        literals = Literals(once.select("alike", "literals").toArrow())
        if not len(literals):
            continue
        found = texts.mapInArrow(_candidates(spark.sparkContext.broadcast(literals)), f"item_id {kind}, text string, rules array<bigint>")
        # Only rules that may match have a text, and only they run.
        found = found.select("item_id", "text", F.explode("rules").alias("alike")).withColumn("run", F.expr("CASE WHEN text IS NOT NULL THEN alike END"))
        found = found.join(F.broadcast(once.select(F.col("alike").alias("run"), *CONDITION)), "run", "left")
        found = found.where(F.col("text").isNull() | (F.expr("rlike(text, pattern)") & _passes_hints())).select("item_id", "alike")
        found = found.join(F.broadcast(block.select(*rest)), "alike").drop("alike")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = texts.select("item_id").join(rules.select(*rest).limit(0), F.lit(False)).drop("alike")
    return out
