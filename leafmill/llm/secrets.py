"""Secret scans by assignment-aware lexing.

Three base kinds are patterns over the whole text. The method proper then lexes source and configuration syntax into
name-literal pairs (=, :, :=, =>; quoted and bare literals; literals joined by +), binds names to their literals, and
carries literals along assignments and keyword arguments to every name that refers to them: by name, by attribute, as
$NAME, ${NAME} or %NAME%, and by a literal key as in os.environ["NAME"]; before or after the name is bound. A literal is
scored by the most sensitive name that it reaches, its length and its mix of characters; what scores enough and is not
fully covered by a base span is a further span, of kind "pair". So is a literal that an assignment pattern ends inside
of, whatever its score. Type annotations before = are passed over; of a dotted name the last nine parts count.

Cases: a null or empty text has no spans; positions count code points, ends are exclusive; equal rows give equal spans;
a text without a sensitive word is not lexed, as no name in it could be sensitive. Time is linear in the length of a text,
also for words of any length: a name is only looked for where a word begins, and no part of the grammar backtracks over it.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions.session import arrow_rows

KINDS = ("assign", "access", "hex", "pair")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Parts of names that hold secrets, with how far each counts.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 0.9, "passphrase": 1.0, "secret": 1.0, "token": 0.9, "apikey": 1.0, "accesskey": 1.0, "privatekey": 1.0, "credential": 0.9, "authorization": 0.8, "bearer": 0.8}
#: What stands where a secret is to be put.
PLACEHOLDERS = frozenset("changeme example placeholder password passwd secret token none null true false undefined xxx todo your redacted".split())
_WORD = r"[A-Za-z_$][\w$]*+"
_NAME = rf"(?<![\w$]){_WORD}(?:[.-]{_WORD}){{0,8}}+"
_LITERAL = r'"(?:[^"\\\n]++|\\.)*+"' + r"|'(?:[^'\\\n]++|\\.)*+'" + r"|`[^`\n]*+`"
_TYPE_NAME = r"[&*]?(?:'\w+[ \t]+)?[A-Za-z_][\w.]*+(?:<[^<>\n=]{0,60}>|\[[^\[\]\n=]{0,60}(?:\[[^\[\]\n=]{0,60}\][^\[\]\n=]{0,60})?\])?\??(?:[ \t]++str\b)?"
_TYPE = rf"""(?:[ \t]*+\??:[ \t]*+{_TYPE_NAME}(?:[ \t]*+\|[ \t]*+{_TYPE_NAME}){{0,8}}|[ \t]++string)(?=[ \t]*+=[ \t]*+["'`]|[ \t]++=[ \t]++[^\s=])"""
_KEYED = r"""[A-Za-z_][\w.]{0,80}+[\[(]["'](?P<key>\w{1,80}+)["']"""
_PAIR = re.compile(
    rf"""(?:(?P<name>{_NAME})|(?P<q>["'])(?P<quoted>[^"'\n]{{1,80}})(?P=q))(?:{_TYPE})?[ \t]*+(?:\[[^\]\n]{{0,40}}\][ \t]*+)?(?::=|=>|=(?!=)|:(?![:/]))[ \t]*+(?P<value>(?:{_LITERAL})(?:[ \t]*+\+[ \t]*+(?:{_LITERAL}))*+|{_KEYED}|[^\s,;"'`#(){{}}\[\]]++(?:(?<=\$)\{{\w++\}})?)(?P<call>\()?"""
)
_PIECE = re.compile(_LITERAL)
_REFERENCE = re.compile(r"\$\{?(\w+)\}?|%(\w+)%|([A-Za-z_][\w.-]*)")
_THRESHOLD = 0.6


def sensitivity(name: str) -> float:
    flat = re.sub(r"[^a-z]", "", name.lower())
    return max((v for k, v in SENSITIVE.items() if k in flat), default=0.0)


def score(literal: str, sensitive: float) -> float:
    """0 to 1: the name's sensitivity, lowered for short, dull and placeholder literals."""
    if len(literal) < 6 or literal.lower().strip("<>*$%{}[]._- ") in PLACEHOLDERS or len(set(literal)) < 4:
        return 0.0
    counts = Counter(literal)
    bits = -sum(n / len(literal) * math.log2(n / len(literal)) for n in counts.values())
    kinds = sum(any(f(c) for c in literal) for f in (str.islower, str.isupper, str.isdigit, lambda c: not c.isalnum()))
    return sensitive * min(1.0, 0.25 + 0.12 * bits + 0.08 * kinds) * (0.4 if " " in literal.strip() else 1.0)


def _reference(value: str, key: str | None) -> str | None:
    """The name that a bare value may stand for."""
    m = _REFERENCE.fullmatch(value)
    return key or (m and (m[1] or m[2] or m[3]))


def pairs(text: str) -> list[tuple[str, int, int, str]]:
    """(name, start, end, literal): every name with each literal that reaches it, in the order they do."""
    bound: dict[str, tuple[int, int, str]] = {}
    waiting: dict[str, list[tuple[str, tuple[int, int, str] | None]]] = {}
    out: list[tuple[str, int, int, str]] = []

    def bind(name: str, literal: tuple[int, int, str]) -> None:
        todo = [name]
        while todo:
            now = todo.pop()
            out.append((now, *literal))
            for known in {now, now.rpartition(".")[2]}:  # an attribute is also known by its last part
                bound[known] = literal
                todo += [n for n, _ in waiting.pop(known, ())]

    for m in _PAIR.finditer(text):
        name, value = m["name"] or m["quoted"], m["value"]
        start, end = m.span("value")
        if value[0] in "\"'`":
            pieces = [p[1:-1] for p in _PIECE.findall(value)]
            bind(name, (start + 1, end - 1, pieces[0]) if len(pieces) == 1 else (start, end, "".join(pieces)))
            continue
        known = _reference(value, m["key"])
        found = known and (bound.get(known) or bound.get(known.rpartition(".")[2]))
        literal = value.rstrip(".!?")
        if found:
            bind(name, found)
        elif known and (m["key"] or value[0] in "$%"):  # can only be a reference
            waiting.setdefault(known, []).append((name, None))
        elif not m["call"]:
            own = (start, start + len(literal), literal)
            if known:  # a word: a literal unless it is bound later on
                waiting.setdefault(known, []).append((name, own))
            else:
                bind(name, own)
    for names in waiting.values():
        out += [(name, *own) for name, own in names if own]
    return out


def lexed(text: str, assigned: list[tuple[int, int]] = ()) -> list[tuple[int, int, str, float]]:
    """(start, end, name, score) of literals that reach a sensitive name, or that one of the assigned spans ends inside of."""
    flat = re.sub(r"[^a-z]", "", text.lower())
    if not any(k in flat for k in SENSITIVE):
        return []
    best: dict[tuple[int, int], tuple[float, str]] = {}
    for name, start, end, literal in pairs(text):
        got = score(literal, sensitivity(name))
        if (start, end) not in best or got > best[start, end][0]:
            best[start, end] = (got, name)
    starts = [a for a, _ in assigned]

    def cut_off(s: int, e: int) -> bool:
        i = bisect_left(starts, s) - 1
        return i >= 0 and s < assigned[i][1] < e

    return sorted((s, e, name, got) for (s, e), (got, name) in best.items() if got >= _THRESHOLD or cut_off(s, e))


def _covers(spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether one of spans, which follow each other, holds start to end."""
    i = bisect_right(spans, start, key=lambda x: x[0]) - 1
    return i >= 0 and end <= spans[i][1]


def find(text: str | None) -> list[tuple[str, int, int, str, float]]:
    """(kind, start, end, name, score) of all spans, by start, then kind."""
    if not text:
        return []
    low = text.lower()
    spans = []
    if "password" in low or "passwd" in low or "secret" in low or "token" in low or "api" in low:
        spans += [("assign", *m.span(), m[1], 1.0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        spans += [("access", *m.span(), "", 1.0) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    spans += [("hex", *m.span(), "", 1.0) for m in _HEX.finditer(text)]
    if "=" in text or ":" in text:
        by_kind = [[(s, e) for kind, s, e, _, _ in spans if kind == k] for k in KINDS[:3]]
        spans += [("pair", s, e, n, got) for s, e, n, got in lexed(text, by_kind[0]) if not any(_covers(x, s, e) for x in by_kind)]
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("name", pa.string()), ("score", pa.float64())])


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans) of every row of df; spans: array of (kind, start, end, name, score)."""
    arrow_rows(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "name", "score"), s, strict=True)) for s in find(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(_SPAN))], ["doc_id", "spans"])

    return df.select(df[id_col].alias("doc_id"), df[text_col].alias("text")).mapInArrow(
        run, f"doc_id {kind}, spans array<struct<kind:string,start:long,end:long,name:string,score:double>>"
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind and the spans as text, from scan()."""
    shown = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    base = F.filter("spans", lambda s: s["kind"] != "pair")
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(F.array_join(F.transform(base, shown), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("spans", shown), ",").alias("spans"),
    )


def redact(df: DataFrame, text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """df with every found span of its text replaced by mark, overlapping spans as one; other columns stay as they are."""
    arrow_rows(df.sparkSession)
    at = df.columns.index(text_col)
    schema = df.schema

    def clean(text):
        spans = find(text)
        if not spans:
            return text
        out, done = [], 0
        for _, start, end, _, _ in spans:
            if start >= done:
                out += [text[done:start], mark]
            done = max(done, end)
        return "".join(out) + text[done:]

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([clean(t) for t in columns[at].to_pylist()], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return df.mapInArrow(run, schema)
