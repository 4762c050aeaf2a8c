"""Secrets in texts: fixed patterns, and literals assigned to sensitive names."""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .name_literals import Pairs, read_pairs

Span = tuple[str, int, int]
"""(kind, start, end): code points, end exclusive."""

KINDS = ("assign", "access", "hex", "literal")

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ASSIGN_LEAST = 6
# A run of 20 or more is found like any run of which the short ones are then dropped.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")

#: A name, an assignment sign, and a quoted literal or a bare value.
PAIR = re.compile(
    r"""(?<![\w.$-])([A-Za-z_$][\w.$-]*+)["'`]?\]?[\x20\t]*+(?::=|=>|=(?!=)|:(?![:/]))[\x20\t]*+"""
    r"""("(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+'|`[^`\n]*+`|[\w+/=.$@!%*#~^-]++)"""
)
#: Further literals of a concatenation.
MORE = re.compile(r"""[\x20\t]*+[+.][\x20\t]*+\n?[\x20\t]*+("(?:[^"\\\n]|\\.)*+"|'(?:[^'\\\n]|\\.)*+')""")
PARTS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")

#: How much a part of a name speaks for a secret.
SENSITIVE = {
    "password": 1.0, "passwd": 1.0, "passphrase": 1.0, "passcode": 1.0, "pass": 0.8, "pwd": 0.9, "pw": 0.6, "secret": 1.0,
    "credential": 0.9, "cred": 0.9, "token": 0.9, "apikey": 1.0, "auth": 0.6, "authorization": 0.8, "bearer": 0.8, "private": 0.5,
    "access": 0.5, "signing": 0.6, "encryption": 0.6, "key": 0.4, "salt": 0.6, "jwt": 0.8, "pin": 0.6,
}
#: Plurals that hold secrets; other plurals are mostly counts and word lists.
PLURAL = frozenset("password passwd passphrase passcode secret credential cred apikey".split())
#: Words that stand beside sensitive ones in lower-case compounds.
BESIDE = "admin api app aws client cloud db git ldap mail master my mysql pg postgres redis root service sign smtp ssh sql user web".split()
COMPOUND = re.compile("(?>" + "|".join(sorted([*SENSITIVE, *BESIDE], key=len, reverse=True)) + ")")
#: What a name must hold to be sensitive, up to the sign that follows it.
GATE = re.compile(
    "(?:pass|pwd|pw|secret|cred|token|key|auth|bearer|private|access|signing|encryption|salt|jwt|pin)"
    r"""[\w.$-]*+["'`\])]*[\x20\t]*+(?:[:=(>,\]]|value|default|content|(?<=[\w-][\x20\t])[^\s])"""
)
#: Parts that make a name one about a secret, not of one.
ABOUT = frozenset("count length size limit hint label field name url uri path type policy min max expiry ttl id index file public error message".split())
#: Names that take nothing from the secrets they stand among.
APART = ABOUT | frozenset("user username login email mail host hostname port server database region domain description comment version date time created updated kind enabled role scope format encoding algorithm title note text".split())
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|-+|changeme|change_me|example|sample|test|none|null|true|false|todo|your[-_ ].*|<.*>|\$\{.*\}|\$\(.*\)|%.*%|\{\{.*\}\})$")
#: Words of a sentence on secrets; a passphrase is words without them.
SENTENCE = frozenset("a an and are be can enter for from incorrect invalid is it must new no not of old or please reset the this to use wrong you your".split())
SCHEME = re.compile(r"(?i)(?:bearer|basic|digest)\x20+(?=\S)")
REFERENCE = re.compile(r"\$\{?([A-Za-z_][\w.]*+)\}?$")
PEM = "-----BEGIN "
#: From this score of a name on, a quoted literal may hold several words.
STRONG = 0.9
THRESHOLD = 0.5


def name_parts(name: str) -> list[str]:
    """Lower-case words of a name, lower-case compounds of known words taken apart."""
    parts = []
    for part in PARTS.findall(name):
        part = part.lower()
        words = [part] if part in SENSITIVE else COMPOUND.findall(part)
        plural = part[-1] == "s" and len(words) > 0 and words[-1] in PLURAL
        parts += words if sum(map(len, words)) + plural == len(part) else [part]
    return parts


@lru_cache(4096)
def name_score(name: str) -> float:
    """How sensitive a target name is, 0 to 1."""
    parts = name_parts(name)
    score = min(1.0, sum(SENSITIVE.get(p, 0.0) for p in parts))
    return score * 0.3 if parts and parts[-1] in ABOUT else score


def stands_apart(name: str) -> bool:
    parts = name_parts(name)
    return bool(parts) and parts[-1] in APART


def literal_score(text: str, quoted: bool, strong: bool = False) -> float:
    """How much a literal looks like a secret value, 0 to 1; several words only under a ``strong`` name."""
    if text.startswith(PEM):
        return 1.0 if "PRIVATE KEY" in text[:60] else 0.0
    if len(text) < 6 or PLACEHOLDER.match(text):
        return 0.0
    words = text.split()
    if len(words) > 1 and not (quoted and strong):
        return 0.0
    if len(words) > 1 and any(w.strip(".,:;!?").lower() in SENTENCE or w.strip(".,:;!?").lower() in SENSITIVE for w in words):
        return 0.0
    counts = [text.count(c) for c in set(text)]
    entropy = -sum(n / len(text) * math.log2(n / len(text)) for n in counts)
    mixed = sum(any(f(c) for c in text) for f in (str.isdigit, str.islower, str.isupper)) + (not text.isalnum())
    score = min(1.0, entropy / 3.0) * (0.7 + 0.15 * min(mixed, 2))
    return score if quoted or any(c.isdigit() for c in text) else score * 0.4


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and non-overlapping per kind."""
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return ordered(found)


def flat_pairs(text: str, pairs: Pairs) -> None:
    """Names directly before their value, wherever they stand, also inside strings and comments."""
    at = 0
    while m := PAIR.search(text, at):
        name, value = m[1], m[2]
        quoted = value[0] in "\"'`"
        at = m.start(2) + 1 if quoted else m.end(2)
        pairs.literals[name].add((m.start(2) + quoted, m.end(2) - quoted, quoted))
        if quoted:
            more = MORE.match(text, m.end())
            while more:
                pairs.literals[name].add((more.start(1) + 1, more.end(1) - 1, True))
                more = MORE.match(text, more.end())
        else:
            pairs.uses[value].add(name)


def bare_start(text: str, start: int, end: int) -> int:
    """Where a literal begins after the scheme of a header."""
    scheme = SCHEME.match(text, start, end)
    return scheme.end() if scheme else start


def literal_spans(text: str) -> list[Span]:
    """Literals whose target names, also those that a constant reaches, are sensitive.

    The text is read into names and literals, by plain pairs and by its structure: calls,
    lists, nested keys, blocks by indent, sections, elements and attributes. A value that is
    itself a name, or a reference to one, passes its literals on to the new name; names that
    lead to each other count together.
    """
    if not GATE.search(text.lower()):
        return []
    pairs = Pairs()
    flat_pairs(text, pairs)
    read_pairs(text, pairs, name_score, stands_apart)
    literals = pairs.literals
    score = {name: s for name in literals if (s := pairs.scores.get(name) or name_score(name))}
    for name, spans in list(literals.items()):
        for start, end, _ in spans:
            if end - start <= 200 and (reference := REFERENCE.match(text[start:end])):
                pairs.uses[reference[1]].add(name)
    score |= {name: s for name, s in pairs.scores.items() if s}
    sources: dict[str, list[str]] = defaultdict(list)
    for constant, names in pairs.uses.items():
        if constant in literals:
            for name in names:
                sources[name].append(constant)
    todo = list(score)
    while todo:
        name = todo.pop()
        for constant in sources.get(name, ()):
            if score.get(constant, 0.0) < score[name]:
                score[constant] = score[name]
                todo.append(constant)
    found = {
        ("literal", start, end)
        for name, s in score.items()
        for first, end, quoted in literals.get(name, ())
        for start in (bare_start(text, first, end),)
        if s * literal_score(text[start:end], quoted, s >= STRONG) >= THRESHOLD and not (not quoted and text[start:end] in literals)
    }
    return outermost(ordered(found))


def outermost(spans: list[Span]) -> list[Span]:
    """Spans that no other one holds."""
    out: list[Span] = []
    for span in sorted(spans, key=lambda x: (x[1], -x[2])):
        if not out or span[2] > out[-1][2]:
            out.append(span)
    return out


def ordered(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_spans(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans): a literal that a base span holds isn't added again."""
    base = base_spans(text)
    added = [x for x in literal_spans(text) if not any(b[1] <= x[1] and x[2] <= b[2] for b in base)]
    return base, ordered(base + added)


def redact(text: str, spans: Iterable[Span], mark: str = "[secret]") -> str:
    """The text with every run of overlapping spans replaced by a mark."""
    out, at = [], 0
    for _, start, end in sorted(spans, key=lambda s: s[1:]):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def joined(spans: Iterable[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Secrets of every text: (id, n_assign, n_access, n_hex, base_sha256, spans).

    spans joins ``kind:start:end`` of all spans by start and kind; base_sha256 is the
    SHA-256 of the base spans joined likewise. A null text counts as empty and has no
    spans. Repeated rows each get their row, other columns are left out, an empty table
    gives no rows. A map over the rows, without an exchange; texts are read in whole.
    """
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField(id_col, kind)]
        + [T.StructField(c, T.LongType()) for c in ("n_assign", "n_access", "n_hex")]
        + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans = ([], [], []), [], []
            for text in batch.column(1).to_pylist():
                base, every = find_spans(text or "")
                for column, name in zip(counts, KINDS):
                    column.append(sum(s[0] == name for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                spans.append(joined(every))
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(scan, schema)


def without_secrets(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars", mark: str = "[secret]") -> DataFrame:
    """The same rows and columns with every secret span replaced by ``mark``.

    Rows are all kept, null texts stay null, and the column of text lengths follows the
    new text if there is one. Other columns are passed through, whatever their names.
    """
    names = docs.columns
    text_at, chars_at = names.index(text_col), names.index(chars_col) if chars_col in names else None

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            texts = columns[text_at].to_pylist()
            new = [t if t is None else redact(t, find_spans(t)[1], mark) for t in texts]
            columns[text_at] = pa.array(new, columns[text_at].type)
            if chars_at is not None:
                kind = columns[chars_at].type
                given = columns[chars_at].to_pylist()
                columns[chars_at] = pa.array([g if t is None or t == o else len(t) for g, t, o in zip(given, new, texts)], kind)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(clean, docs.schema)
