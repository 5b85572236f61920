"""Secrets in texts: patterns, and encodings that are confirmed by decoding and parsing them.

A run of base64 or hex says little by itself.  It is reported when its bytes are the
encoding of a private key, every length inside agreeing with what surrounds it, or when
it is a token with a readable header, payload and signature.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as S

from starflow.llm import text as T

#: In the order in which spans that start together are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "jwt", "key")

_ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_ANY_HEX = re.compile(r"(?<![0-9A-Za-z])(?:[0-9a-f]{64,}|[0-9A-F]{64,})(?![0-9A-Za-z])")
# No other BEGIN in the body: a mention, or a key cut short, must not reach for the next key's END.
_PEM = re.compile(r"-----BEGIN ([A-Z0-9 ]*PRIVATE KEY)-----((?:(?!-----BEGIN ).)*?)-----END \1-----", re.S)
_JWT = re.compile(r"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,})\.([A-Za-z0-9_-]{4,})\.([A-Za-z0-9_-]{16,})(?![A-Za-z0-9_-])")
# Where the base64 of DER or of an OpenSSH key may begin, whatever stands before it.
_KEY_START = re.compile(r"(?=M[A-P][A-Za-z0-9+/_-]{14}|b3BlbnNzaC1rZXkt)")
_SIGN = r"\\+u002[bBfF]|\\+/|[A-Za-z0-9+/_-]"
_SIGNS, _CHUNK = re.compile(_SIGN), re.compile(f"(?:{_SIGN})+")
# A line's end, also written as two characters, with the quoting around it.
_BREAK = re.compile(r"""(?:\\+[nrt])*["'`]?[ \t]*[+,.&\\]?[ \t]*[\r\n]+[\s>#*|]*["'`]?|(?:\\+[nrt])+[ \t]*""")
_PADDING = re.compile(r"(?:=|\\+u003[dD]){0,2}")
_LEAST_KEY = 40

_SEQUENCE, _INTEGER, _OCTETS, _OID = 0x30, 0x02, 0x04, 0x06
_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
SPANS_TYPE = S.ArrayType(S.StructType().add("kind", "string").add("start", "integer").add("end", "integer"))


def decoded(run: str) -> bytes | None:
    """Bytes of base64 in either alphabet, with or without its padding."""
    run = run.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(run + "=" * (-len(run) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _item(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """Tag, and bounds of the content, of the DER item at ``at``, which must not reach beyond ``end``."""
    if at + 2 > end:
        return None
    tag, size, at = data[at], data[at + 1], at + 2
    if size & 0x80:
        wide = size & 0x7F
        if not 1 <= wide <= 4 or at + wide > end:
            return None
        size, at = int.from_bytes(data[at:at + wide], "big"), at + wide
    return (tag, at, at + size) if at + size <= end else None


def _few_items(data: bytes, at: int, end: int, most: int = 9) -> list[tuple[int, int, int]] | None:
    """The items that fill these bounds exactly, if they are few; only their heads are read."""
    items = []
    while at < end:
        item = _item(data, at, end)
        if item is None or len(items) == most:
            return None
        items.append(item)
        at = item[2]
    return items


def der_key_size(data: bytes, at: int) -> int | None:
    """Bytes of the RSA, DSA, EC or wrapped private key in DER that begins at ``at``.

    Reads the heads of a few items and never their contents, however long they say they are.
    """
    outer = _item(data, at, len(data))
    if outer is None or outer[0] != _SEQUENCE:
        return None
    items = _few_items(data, outer[1], outer[2])
    if not items or len(items) < 2:
        return None
    tags, sizes = [t for t, _, _ in items], [b - a for _, a, b in items]
    first = data[items[0][1]:items[0][2]] if sizes[0] == 1 else b""

    def algorithm(k: int) -> bool:
        inner = _few_items(data, items[k][1], items[k][2]) if tags[k] == _SEQUENCE else None
        return bool(inner) and inner[0][0] == _OID

    if tags[0] == _INTEGER and len(items) in (6, 9) and set(tags) == {_INTEGER}:
        good = first == b"\0" and sizes[1] >= 32
    elif tags[:2] == [_INTEGER, _OCTETS] and first == b"\1":
        good = sizes[1] >= 16 and all(tag & 0xE0 == 0xA0 for tag in tags[2:])
    elif tags[0] == _INTEGER and tags[2:3] == [_OCTETS] and first in (b"\0", b"\1"):
        good = algorithm(1) and _few_items(data, items[2][1], items[2][2]) is not None
    else:
        good = tags == [_SEQUENCE, _OCTETS] and algorithm(0) and sizes[1] >= 32
    return outer[2] - at if good else None


def der_private_key(data: bytes) -> bool:
    """Is this an RSA, DSA, EC or wrapped private key, whole and with nothing after it?"""
    return der_key_size(data, 0) == len(data)


def openssh_size(data: bytes, begin: int = 0) -> int | None:
    """Bytes of the OpenSSH key file's content that begins at ``begin``, if its nested lengths all fit."""
    magic = b"openssh-key-v1\0"
    if not data.startswith(magic, begin):
        return None
    at = begin + len(magic)

    def string() -> int:
        """Size of the next string, which is stepped over."""
        nonlocal at
        size = int.from_bytes(data[at:at + 4], "big")
        if at + 4 + size > len(data):
            raise ValueError
        at += 4 + size
        return size

    try:
        cipher, _, _ = string(), string(), string()
        keys = int.from_bytes(data[at:at + 4], "big")
        at += 4
        if not cipher or not 1 <= keys <= 16:
            return None
        public = [string() for _ in range(keys)]
        return at - begin if all(size > 8 for size in public) and string() >= 16 else None
    except ValueError:
        return None


def openssh_private_key(data: bytes) -> bool:
    """Is this an OpenSSH key file's content, its nested lengths all fitting?"""
    return openssh_size(data) == len(data)


def private_key(data: bytes | None) -> bool:
    return data is not None and len(data) >= 16 and (der_private_key(data) or openssh_private_key(data))


def signed_token(header: str, payload: str) -> bool:
    """Do the first two parts decode to a header naming an algorithm and to a payload?"""
    parts = []
    for part in (header, payload):
        data = decoded(part)
        try:
            parts.append(json.loads(data.decode()) if data else None)
        except (ValueError, RecursionError):
            return False
    algorithm = parts[0].get("alg") if isinstance(parts[0], dict) else None
    return isinstance(algorithm, str) and algorithm.lower() != "none" and isinstance(parts[1], dict)


def _plain(sign: str) -> str:
    return sign if len(sign) == 1 else "+" if sign[-1] in "bB" else "/"


class _Run:
    """Base64 from some place on, over line breaks: decoded once, for all keys that may begin in it."""

    def __init__(self, text: str, at: int) -> None:
        signs, starts, ends = [], [], []
        while chunk := _CHUNK.match(text, at):
            if "\\" in chunk[0]:
                for m in _SIGNS.finditer(text, at, chunk.end()):
                    signs.append(_plain(m[0]))
                    starts.append(np.array([m.start()]))
                    ends.append(np.array([m.end()]))
            else:
                signs.append(chunk[0])
                starts.append(np.arange(at, chunk.end()))
                ends.append(np.arange(at + 1, chunk.end() + 1))
            gap = _BREAK.match(text, chunk.end())
            if not gap:
                break
            at = gap.end()
        self.signs = "".join(signs).replace("-", "+").replace("_", "/")
        self.starts, self.ends = np.concatenate(starts), np.concatenate(ends)
        self.decoded: dict[int, bytes] = {}

    def place(self, at: int) -> int | None:
        """Which sign begins at this place of the text."""
        k = int(np.searchsorted(self.starts, at))
        return k if k < len(self.starts) and self.starts[k] == at else None

    def bytes_from(self, sign: int) -> tuple[bytes, int]:
        """The run's bytes as they are if a group of four begins at ``sign``, and where that group's are."""
        shift = sign % 4
        if shift not in self.decoded:
            run = self.signs[shift:]
            run = run[:-1] if len(run) % 4 == 1 else run
            self.decoded[shift] = base64.b64decode(run + "=" * (-len(run) % 4))
        return self.decoded[shift], sign // 4 * 3


def _key_end(text: str, at: int, runs: list[_Run]) -> int | None:
    """End of the private key whose base64 begins at ``at``; its own lengths say how far it goes."""
    sign = runs[-1].place(at) if runs else None
    if sign is None:
        runs[:] = [_Run(text, at)]
        sign = 0
    data, begin = runs[-1].bytes_from(sign)
    size = openssh_size(data, begin) if text.startswith("b3Bl", at) else der_key_size(data, begin)
    need = -(-size * 4 // 3) if size else 0
    if size is None or size < 16 or not _LEAST_KEY <= need <= len(runs[-1].signs) - sign:
        return None
    return _PADDING.match(text, int(runs[-1].ends[sign + need - 1])).end()


def _pem_body(body: str) -> bytes | None:
    """Bytes of armoured base64, also where line ends are written as two characters or lines are quoted."""
    body = re.sub(r"\\+[nrt]", "\n", body)
    body = re.sub(r"\\+u003[dD]", "=", re.sub(r"\\+u002[bBfF]|\\+/", lambda m: _plain(m[0]), body))
    # Lines with a colon are headers, as encrypted keys have.
    lines = (re.sub(r"""["'`][ \t]*[+,.&;]?[ \t]*\\?$""", "", x.strip()) for x in body.splitlines() if ":" not in x)
    return decoded("".join("".join(x.strip(" \t\"'`,;>#*|\\").split()) for x in lines))


def find(text: str | None) -> list[tuple[int, int, int]]:
    """Start, kind (its place in ``KINDS``) and end of each secret, in code points, in order."""
    if not text:
        return []
    found, armoured = set(), []
    if ":" in text or "=" in text:
        found.update((m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8)
    if "AKIA" in text:
        found.update((m.start(), 1, m.end()) for m in _ACCESS.finditer(text))
    found.update((m.start(), 2, m.end()) for m in _HEX.finditer(text))
    if "-----BEGIN " in text:
        for m in _PEM.finditer(text):
            data = _pem_body(m[2])
            if private_key(data) or (data and "ENCRYPTED" in m[2] and len(data) >= 64):
                found.add((m.start(), 3, m.end()))
                armoured.append((m.start(), m.end()))
    if "." in text and "ey" in text:
        at = 0
        while m := _JWT.search(text, at):
            if signed_token(m[1], m[2]):
                found.add((m.start(), 4, m.end()))
                at = m.end()
            else:
                at = m.start(2)
    done, runs = 0, []
    for m in _KEY_START.finditer(text):
        while armoured and armoured[0][1] <= m.start():
            armoured.pop(0)
        if m.start() < done or armoured and armoured[0][0] <= m.start():
            continue
        end = _key_end(text, m.start(), runs)
        if end:
            found.add((m.start(), 5, end))
            done = end
    for m in _ANY_HEX.finditer(text):
        if len(m[0]) % 2 == 0 and private_key(bytes.fromhex(m[0])):
            found.add((m.start(), 5, m.end()))
    return sorted(found)


def scan_secrets(docs: DataFrame, text_col: str = "text", name: str = "secrets") -> DataFrame:
    """``docs`` without its text, and ``name``: the kind, start and end of each secret.

    Spans are in code points, the end exclusive, ordered by start and then by kind.
    Null and empty texts have none; repeated rows are each scanned.  A column called
    ``name`` is replaced.
    """
    others = [c for c in docs.columns if c not in (text_col, name)]

    def run(batches):
        for batch in batches:
            spans = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in find(x.as_py())]
                     for x in batch.column(len(others))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(spans, _SPANS)],
                                             names=[*others, name])

    T.prepare_workers(docs.sparkSession)
    kept = docs.select(*others, text_col)
    return kept.mapInArrow(run, kept.drop(text_col).schema.add(name, SPANS_TYPE))


def without_secrets(text: str | None, mark: str = "[secret]") -> str | None:
    """The text with each secret replaced; spans that overlap are replaced as one."""
    pieces, at, open_to = [], 0, -1
    for start, _, end in find(text):
        if start >= open_to:
            pieces += [text[at:start], mark]
            open_to = end
        open_to = at = max(open_to, end)
    return "".join([*pieces, text[at:]]) if pieces else text


def redact_secrets(docs: DataFrame, text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``docs`` with secrets replaced in its texts; ``size_col``, if there, is each text's new length.

    Every row and column is kept.  A text without secrets, empty or null stays as it is,
    and so does the size beside a null text.
    """
    names, schema = docs.columns, docs.schema
    at = names.index(text_col)
    size_at = names.index(size_col) if size_col in names else None

    def run(batches):
        for batch in batches:
            columns = list(batch.columns)
            before = columns[at].to_pylist()
            after = [without_secrets(x) for x in before]
            columns[at] = pa.array(after, columns[at].type)
            if size_at is not None:
                sizes = columns[size_at].to_pylist()
                columns[size_at] = pa.array([n if a is b or a == b else len(a)
                                             for a, b, n in zip(after, before, sizes)],
                                            columns[size_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    T.prepare_workers(docs.sparkSession)
    return docs.mapInArrow(run, schema)


def _of(kinds, secrets: str) -> Column:
    return F.filter(secrets, lambda s: s["kind"].isin(*kinds))


def joined(spans: Column) -> Column:
    """Spans as kind:start:end, with commas between."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digests(scanned: DataFrame, secrets: str = "secrets") -> DataFrame:
    counts = {f"n_{k}": F.size(_of([k], secrets)).cast("bigint") for k in BASE_KINDS}
    return (scanned.withColumns(counts)
            .withColumn("base_sha256", F.sha2(joined(_of(BASE_KINDS, secrets)).cast("binary"), 256))
            .withColumn("spans", joined(F.col(secrets))).drop(secrets))
