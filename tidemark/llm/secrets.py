"""Secrets in texts: fixed patterns, and runs whose characters a public vocabulary can't merge into few tokens.

Random strings cost a byte-pair vocabulary about one token for two characters, words far fewer. A candidate is a run of
key characters that mixes letters and digits (12 or more), or of letters alone (20 or more); runs that are digests or
identifiers by their form are left out.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame

from .text import documents, kept, slices
from .tokens import vocabulary

KINDS = ("assign", "access", "hex", "random")
# The patterns of assignments, access keys and long hexadecimal runs, with their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGNED = 8

#: Runs that the token test looks at, and its limits in characters to a token: of runs of SURE characters or more that mix
#: letters and digits, and of shorter ones and those of letters alone (SURE characters or more), where words are likelier.
RUN, SURE = re.compile(r"[A-Za-z0-9+/_-]{12,}={0,2}"), 20
RATIO, TIGHT = 2.2, 1.9
#: Digests (md5, sha-1, sha-2 in hexadecimal), UUIDs, numbers, and dashed or underscored names of words.
KNOWN = re.compile(
    r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}"
    r"|[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
    r"|[0-9+/_-]+=*|(?:[A-Za-z]+|[0-9]{1,4})(?:[-_/](?:[A-Za-z]+|[0-9]{1,4}))+)\Z"
)
MIXED = re.compile(r"(?=.*[A-Za-z])(?=.*[0-9])", re.ASCII)


def encoding(path: str):
    """The worker's encoder of that file."""

    def make():
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    return kept(f"vocabulary {path}", make)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points; an assignment's span is the whole match."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGNED]
    out += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    return out + [(*m.span(), "hex") for m in HEX.finditer(text)]


def random_spans(text: str, coder, ratio: float = RATIO, tight: float = TIGHT) -> list[tuple[int, int, str]]:
    """Runs of few characters to a token, known digests and identifiers left out."""
    out = []
    for m in RUN.finditer(text):
        run = m[0]
        mixed = MIXED.match(run) is not None
        if (mixed or len(run) >= SURE) and not KNOWN.match(run):
            if len(run) < (ratio if mixed and len(run) >= SURE else min(ratio, tight)) * len(coder.encode_ordinary(run)):
                out.append((*m.span(), "random"))
    return out


def digest(spans: list[tuple[int, int, str]]) -> str:
    """kind:start:end by start, then by the order of kinds, comma-joined."""
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1])))


def _scan(path: str, ratio: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(path)
        for b in slices(batches):
            rows = []
            for text in b.column("text").to_pylist():
                base = base_spans(text or "")
                n = [sum(k == kind for _, _, k in base) for kind in KINDS[:3]]
                rows.append((*n, sha256(digest(base).encode()).hexdigest(), digest(base + (more := random_spans(text or "", coder, ratio))), len(more)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], NAMES)

    return run


NAMES = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"]


def secret_spans(docs: DataFrame, path: str | None = None, ratio: float = RATIO) -> DataFrame:
    """Per row of docs(doc_id, text): spans of secrets in code points, end exclusive, and their numbers by kind.

    A null or empty text has no span. Each row is looked at by itself, so repeated rows and ids give as many rows.
    """
    return documents(docs).mapInArrow(_scan(path or vocabulary("byte_bpe_50k.tiktoken"), ratio), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")


def _redact(path: str, ratio: float, mark: str):
    def one(text: str | None, coder) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for a, b, kind in sorted(base_spans(text) + random_spans(text, coder, ratio)):
            if b <= at:
                continue
            if a >= at:
                out += [text[at:a], mark.format(kind=kind)]
            at = b
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoding(path)
        for b in slices(batches):
            at = b.schema.get_field_index("text")
            yield b.set_column(at, b.schema.field(at), pa.array([one(t, coder) for t in b.column("text").to_pylist()], b.schema.field(at).type))

    return run


def redacted(docs: DataFrame, path: str | None = None, ratio: float = RATIO, mark: str = "<{kind}>") -> DataFrame:
    """docs with each secret (overlapping ones as one) replaced by mark; all other columns and rows as they are.

    Null and empty texts stay as they are, texts of any length are read whole, and rows are looked at one by one.
    """
    return docs.mapInArrow(_redact(path or vocabulary("byte_bpe_50k.tiktoken"), ratio, mark), docs.schema)
