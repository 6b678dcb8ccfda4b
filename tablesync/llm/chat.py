"""Operator 6: records of many layouts to chat text, by fingerprints of their nested field paths."""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Turn:
    """One turn: a role, and the fields whose non-empty texts are joined by a blank line."""

    role: str
    texts: tuple[str, ...]


@dataclass(frozen=True)
class Each:
    """A turn for every element of a list: the elements' fields for role and text, and other names of roles."""

    items: str
    role: str
    text: str
    roles: dict[str, str] = field(default_factory=dict, hash=False)


@dataclass(frozen=True)
class Layout:
    """A declared mapping: the field paths that records have or may have, and the turns made of them."""

    name: str
    turns: tuple[Turn | Each, ...]
    optional: tuple[str, ...] = ()
    row: tuple[str, str, str] | None = None  # (turn number, role, text) where a record is a single turn

    def shapes(self) -> Iterator[frozenset[str]]:
        """Every set of paths that this layout covers."""
        fixed: set[str] = set(self.row or ())
        lists: list[tuple[frozenset, frozenset]] = []
        for t in self.turns:
            if isinstance(t, Each):
                lists.append((frozenset([f"{t.items}[]"]), frozenset([f"{t.items}[]", f"{t.items}[].{t.role}", f"{t.items}[].{t.text}"])))
            else:
                fixed.update(x for x in t.texts if x not in self.optional)
        for some in itertools.product(*lists):  # an empty list has no elements' paths
            for n in range(len(self.optional) + 1):
                for more in itertools.combinations(self.optional, n):
                    yield frozenset(fixed).union(*some, more)


_SHARE = {"human": "user", "gpt": "assistant"}
LAYOUTS = (
    Layout("turn_rows", (), ("conv_id",), ("turn", "role", "text")),
    Layout("messages", (Each("messages", "role", "content"),), ("conv_id",)),
    Layout("conversations", (Each("conversations", "from", "value", _SHARE),), ("conv_id",)),
    Layout("prompt_response", (Turn("system", ("system",)), Turn("user", ("prompt",)), Turn("assistant", ("response",))), ("conv_id", "system")),
    Layout("prompt_completion", (Turn("user", ("prompt",)), Turn("assistant", ("completion",))), ("conv_id",)),
    Layout(
        "instruction",
        (Turn("system", ("system",)), Turn("user", ("instruction", "input")), Turn("assistant", ("output",))),
        ("conv_id", "system", "input"),
    ),
)


def paths(value, at: str = "") -> set[str]:
    """The nested field paths of a JSON value; list elements share the path ``[]``."""
    found: set[str] = set()
    todo = [(value, at)]
    while todo:
        v, p = todo.pop()
        if isinstance(v, dict) and (v or not p):
            todo += [(x, f"{p}.{k}" if p else k) for k, x in v.items()]
        elif isinstance(v, list):
            found.add(f"{p}[]")
            todo += [(x, f"{p}[]") for x in v]
        else:
            found.add(p)
    return found


def fingerprint(shape) -> str:
    return hashlib.blake2b("\n".join(sorted(shape)).encode(), digest_size=8).hexdigest()


def _mappings(layouts: tuple[Layout, ...]) -> dict[str, Layout]:
    found: dict[str, Layout] = {}
    for layout in layouts:
        for shape in layout.shapes():
            if found.setdefault(fingerprint(shape), layout) is not layout:
                raise ValueError(f"layouts {found[fingerprint(shape)].name} and {layout.name} have the same fields")
    return found


def _said(v) -> str:
    return "" if v is None else v if isinstance(v, str) else json.dumps(v, ensure_ascii=False)


def _turns(record: dict, layout: Layout) -> Iterator[tuple[int | None, str, str]]:
    if layout.row:
        number, role, text = (record.get(k) for k in layout.row)
        yield number if isinstance(number, int) else None, _said(role), _said(text)
        return
    n = 0
    for t in layout.turns:
        if isinstance(t, Each):
            for item in record.get(t.items) or ():
                role = _said(item.get(t.role))
                yield n, t.roles.get(role, role), _said(item.get(t.text))
                n += 1
        elif any(x in record for x in t.texts):
            yield n, t.role, "\n\n".join(s for s in (_said(record.get(x)) for x in t.texts) if s)
            n += 1


_TURNS = "conv_id string, turn long, role string, text string, layout string, fingerprint string"


def canonical_turns(records: DataFrame, record_col: str = "record", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """One row per turn: conv_id, turn, role, text, layout, fingerprint, from JSON records of different layouts.

    A record's fingerprint is the hash of its nested field paths; it selects the mapping. A record whose paths no layout
    declares, or that is no JSON object, or null, is kept as one row with layout null, its raw text and no role. A null
    field is present: a null text is empty, a null role ''. ``conv_id`` is the record's, as text, else null.
    """
    known = _mappings(layouts)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for raw in batch.column(0).to_pylist():
                try:
                    record = json.loads(raw) if raw is not None else None
                except ValueError:
                    record = None
                mark = fingerprint(paths(record)) if isinstance(record, dict) else None
                layout = known.get(mark)
                if layout is None:
                    out.append((None, None, None, raw, None, mark))
                    continue
                conv = None if record.get("conv_id") is None else _said(record["conv_id"])
                out += [(conv, *turn, layout.name, mark) for turn in _turns(record, layout)]
            cols = zip(*out, strict=True) if out else ((),) * 6
            kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=_TURNS.replace(",", "").split()[::2])

    return records.select(record_col).mapInArrow(read, _TURNS)


_PLAIN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    r"""No ``<|`` is left: ``<`` and ``|`` with backslashes between get one more."""
    return _PLAIN.sub(r"<\\\1|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def _role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _read_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


_SEGMENTS = "conv_id string, seq long, segment string, loss_start long, loss_end long"


def format_chats(turns: DataFrame) -> DataFrame:
    r"""One row per turn: conv_id, seq, segment, loss_start, loss_end; a conversation's text is its segments by seq.

    A segment is ``<|im_start|>role\ntext<|im_end|>\n`` with control strings inside role and text escaped reversibly. The
    loss mask of a segment is the text of an assistant's turn, given in code points; of others it is empty. Turns are
    put in order by number (null first), then role and text, so repeated rows are repeated turns.
    Rows of one conversation meet in one task, as their order asks for, but stream through it: none is held.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, seq = object(), 0
        for batch in batches:
            conv, role, text = (batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))
            out = []
            for c, r, t in zip(conv, role, text, strict=True):
                at, seq = (c, 0) if c != at else (at, seq + 1)
                head, body = f"{START}{_role(r or '')}\n", escape(t or "")
                lost = len(body) if r == "assistant" else 0
                out.append((c, seq, f"{head}{body}{END}\n", len(head), len(head) + lost))
            yield _batch(out, _SEGMENTS)

    dealt = turns.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(write, _SEGMENTS)


_DIGESTS = "conv_id string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def read_back(segments: DataFrame) -> DataFrame:
    """One row per conversation, read from its text: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    ``segments`` as ``format_chats`` leaves them: a conversation's rows lie together and in order. A text that does not
    parse is an error.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, now = object(), None
        for batch in batches:
            out = []
            for c, _, segment, a, b in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
                if c != at:
                    if now:
                        out.append(now.row(at))
                    at, now = c, _Digest()
                now.add(segment, segment[a:b], b > a)
            yield _batch(out, _DIGESTS)
        if now:
            yield _batch([now.row(at)], _DIGESTS)

    return segments.mapInArrow(read, _DIGESTS)


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.lost = self.chars = 0

    def add(self, segment: str, masked: str, has_loss: bool) -> None:
        head, end = segment.find("\n"), segment.find(END)
        if not segment.startswith(START) or head < 0 or segment[end:] != END + "\n":
            raise ValueError(f"not a turn: {segment[:80]!r}")
        role, text = _read_role(segment[len(START) : head]), unescape(segment[head + 1 : end])
        self.turns.update(f"{role}\n{text}\n".encode())
        if has_loss:
            said = unescape(masked)
            self.loss.update(said.encode())
            self.lost += len(said)
        self.n += 1
        self.chars += len(segment)

    def row(self, conv) -> tuple:
        return conv, self.n, self.turns.hexdigest(), self.lost, self.loss.hexdigest(), self.chars


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in ddl.split(", ")), strict=True)
    cols = zip(*rows, strict=True) if rows else ((),) * len(names)
    types = [pa.string() if k == "string" else pa.int64() for k in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=list(names))


def turn_records(turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text") -> DataFrame:
    """Table rows as JSON records of the layout ``turn_rows``, in a column ``record``."""
    cols = [F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")]
    return turns.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("record"))
