"""Media columns: Matroska files written from payloads and parsed into packet tables.

The parser walks EBML elements (variable-length ids and sizes, unknown sizes included), follows clusters,
undoes Xiph, EBML and fixed lacing and reads cues. A packet row has its track, timestamp and byte range.

Null media give no packet and a null feature; damaged media give an error text in ``error`` and no packet
rows; an empty text's payload is 64 zero bytes. Repeated rows give repeated results. Only the id and media
columns are read, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywell.llm.common import id_text, ready, rows_to_batch, texts_of

# Element ids of EBML and Matroska.
EBML, DOC_TYPE, VOID, CRC = 0x1A45DFA3, 0x4282, 0xEC, 0xBF
EBML_VERSION, EBML_READ_VERSION, MAX_ID, MAX_SIZE, DOC_VERSION, DOC_READ_VERSION = 0x4286, 0x42F7, 0x42F2, 0x42F3, 0x4287, 0x4285
SEGMENT, INFO, TIMESTAMP_SCALE, MUXING_APP, WRITING_APP, DURATION = 0x18538067, 0x1549A966, 0x2AD7B1, 0x4D80, 0x5741, 0x4489
TRACKS, TRACK_ENTRY, TRACK_NUMBER, TRACK_UID, TRACK_TYPE, FLAG_LACING, CODEC_ID = 0x1654AE6B, 0xAE, 0xD7, 0x73C5, 0x83, 0x9C, 0x86
DEFAULT_DURATION, AUDIO, SAMPLING_FREQUENCY, CHANNELS, BIT_DEPTH = 0x23E383, 0xE1, 0xB5, 0x9F, 0x6264
CLUSTER, TIMESTAMP, SIMPLE_BLOCK, BLOCK_GROUP, BLOCK, BLOCK_DURATION, REFERENCE = 0x1F43B675, 0xE7, 0xA3, 0xA0, 0xA1, 0x9B, 0xFB
CUES, CUE_POINT, CUE_TIME, CUE_TRACK_POSITIONS, CUE_TRACK, CUE_CLUSTER_POSITION = 0x1C53BB6B, 0xBB, 0xB3, 0xB7, 0xF7, 0xF1
SEEK_HEAD, CHAPTERS, TAGS, ATTACHMENTS = 0x114D9B74, 0x1043A770, 0x1254C367, 0x1941A469

TOP_LEVEL = {SEGMENT, SEEK_HEAD, INFO, TRACKS, CLUSTER, CUES, CHAPTERS, TAGS, ATTACHMENTS, EBML}
UNKNOWN = -1
RATE = 8000  # samples a second; a sample is a byte
FRAME = 512  # bytes a frame
LACED = 8  # frames a block
BLOCKS = 8  # blocks a cluster


class Packet(NamedTuple):
    track: int
    timestamp_ns: int
    offset: int
    size: int
    cluster: int
    block: int
    lacing: str
    keyframe: bool


class Media(NamedTuple):
    doc_type: str
    scale_ns: int
    duration: float | None
    tracks: list[dict]
    packets: list[Packet]
    cues: list[tuple[int, int, int]]  # time in ns, track, byte position of the cluster
    clusters: list[int]  # byte positions


# --- writing


def vint(n: int, width: int = 0) -> bytes:
    """n as a variable-length size; all-ones values stand for an unknown size and are avoided."""
    need = width or max(1, -(-(n + 2).bit_length() // 7) if (n + 2).bit_length() > 7 else 1)
    while n >= (1 << (7 * need)) - 1:
        need += 1
    return ((1 << (7 * need)) | n).to_bytes(need, "big")


def _id(i: int) -> bytes:
    return i.to_bytes((i.bit_length() + 7) // 8, "big")


def element(i: int, body: bytes) -> bytes:
    return _id(i) + vint(len(body)) + body


def uint(i: int, n: int) -> bytes:
    return element(i, n.to_bytes(max(1, (n.bit_length() + 7) // 8), "big"))


def _float(i: int, x: float) -> bytes:
    return element(i, np.array(x, ">f8").tobytes())


def lace(frames: list[bytes], kind: str) -> tuple[int, bytes]:
    """The lacing flag and the laced bytes, of the kind none, xiph, fixed or ebml."""
    if kind == "none":
        if len(frames) != 1:
            raise ValueError("a block without lacing has one frame")
        return 0, frames[0]
    if kind not in ("xiph", "ebml", "fixed"):
        raise ValueError(f"unknown lacing {kind}")
    if not 1 <= len(frames) <= 256:
        raise ValueError("a lace has 1 to 256 frames")
    sizes, head = [len(f) for f in frames], bytes([len(frames) - 1])
    if kind == "fixed":
        if len(set(sizes)) != 1:
            raise ValueError("fixed lacing needs frames of one size")
        return 0x04, head + b"".join(frames)
    if kind == "xiph":
        return 0x02, head + b"".join(b"\xff" * (n // 255) + bytes([n % 255]) for n in sizes[:-1]) + b"".join(frames)
    parts = [vint(sizes[0])] if len(sizes) > 1 else []
    for a, b in zip(sizes, sizes[1:-1]):
        d, width = b - a, 1
        while abs(d) >= (1 << (7 * width - 1)) - 1:
            width += 1
        parts.append(vint(d + (1 << (7 * width - 1)) - 1, width))
    return 0x06, head + b"".join(parts) + b"".join(frames)


_HEAD = element(EBML, uint(EBML_VERSION, 1) + uint(EBML_READ_VERSION, 1) + uint(MAX_ID, 4) + uint(MAX_SIZE, 8) + element(DOC_TYPE, b"matroska") + uint(DOC_VERSION, 4) + uint(DOC_READ_VERSION, 2))
_TRACKS = element(TRACKS, element(TRACK_ENTRY, uint(TRACK_NUMBER, 1) + uint(TRACK_UID, 1) + uint(TRACK_TYPE, 2) + uint(FLAG_LACING, 1) + element(CODEC_ID, b"A_PCM/INT/LIT") + uint(DEFAULT_DURATION, FRAME * 10**9 // RATE) + element(AUDIO, _float(SAMPLING_FREQUENCY, RATE) + uint(CHANNELS, 1) + uint(BIT_DEPTH, 8))))


def write(payload: bytes) -> bytes:
    """payload as 8-bit samples of one audio track: frames of 512 bytes, eight to a laced block.

    Blocks of equal frames use fixed lacing, the last block EBML lacing, or none for a single frame.
    """
    info = element(INFO, uint(TIMESTAMP_SCALE, 10**6) + element(MUXING_APP, b"tallywell") + element(WRITING_APP, b"tallywell") + _float(DURATION, len(payload) * 1000 / RATE))
    parts, at, cues = [info, _TRACKS], len(info) + len(_TRACKS), []
    per_block = FRAME * LACED
    for start in range(0, len(payload), per_block * BLOCKS):
        base, body = start * 1000 // RATE, []
        for b in range(start, min(start + per_block * BLOCKS, len(payload)), per_block):
            frames = [payload[i : i + FRAME] for i in range(b, min(b + per_block, len(payload)), FRAME)]
            flag, data = lace(frames, "none" if len(frames) == 1 else "fixed" if len(frames[-1]) == FRAME else "ebml")
            body.append(element(SIMPLE_BLOCK, b"\x81" + (b * 1000 // RATE - base).to_bytes(2, "big", signed=True) + bytes([0x80 | flag]) + data))
        cluster = element(CLUSTER, uint(TIMESTAMP, base) + b"".join(body))
        cues.append(element(CUE_POINT, uint(CUE_TIME, base) + element(CUE_TRACK_POSITIONS, uint(CUE_TRACK, 1) + uint(CUE_CLUSTER_POSITION, at))))
        parts.append(cluster)
        at += len(cluster)
    parts.append(element(CUES, b"".join(cues)))
    return _HEAD + element(SEGMENT, b"".join(parts))


# --- parsing


def read_id(b: bytes, at: int, end: int) -> tuple[int, int]:
    if at >= end or not b[at]:
        raise ValueError(f"no element id at byte {at}")
    width = 9 - b[at].bit_length()
    if width > 4 or at + width > end:
        raise ValueError(f"bad element id at byte {at}")
    return int.from_bytes(b[at : at + width], "big"), at + width


def read_vint(b: bytes, at: int, end: int) -> tuple[int, int, int]:
    """The value (UNKNOWN if all its bits are set), the place after it, its width."""
    if at >= end or not b[at]:
        raise ValueError(f"no size at byte {at}")
    width = 9 - b[at].bit_length()
    if at + width > end:
        raise ValueError(f"cut size at byte {at}")
    mask = (1 << (7 * width)) - 1
    n = int.from_bytes(b[at : at + width], "big") & mask
    return (UNKNOWN if n == mask else n), at + width, width


def elements(b: bytes, at: int, end: int) -> Iterator[tuple[int, int, int]]:
    """(id, start, end) of the bodies of the elements from at to end; one of unknown size ends at the next
    element that cannot be its child, or at end."""
    while at < end:
        i, at = read_id(b, at, end)
        n, at, _ = read_vint(b, at, end)
        stop = at + n
        if n == UNKNOWN:
            if i not in (SEGMENT, CLUSTER):
                raise ValueError(f"unknown size of element {i:X}")
            stop = at
            while stop < end:
                j, body = read_id(b, stop, end)
                if j == SEGMENT or j == EBML or i == CLUSTER and j in TOP_LEVEL:
                    break
                m, body, _ = read_vint(b, body, end)
                if m == UNKNOWN:
                    if j != CLUSTER:
                        raise ValueError(f"unknown size of element {j:X}")
                    m = next(e for k, s, e in elements(b, stop, end)) - body
                stop = body + m
        if stop > end:
            raise ValueError(f"element {i:X} runs past byte {end}")
        yield i, at, stop
        at = stop


def _uint(b: bytes, s: int, e: int) -> int:
    return int.from_bytes(b[s:e], "big")


def _real(b: bytes, s: int, e: int) -> float:
    if e - s not in (0, 4, 8):
        raise ValueError(f"a float of {e - s} bytes at byte {s}")
    return 0.0 if s == e else float(np.frombuffer(b[s:e], f">f{e - s}")[0])


def _within(x: int, bits: int, what: str) -> int:
    if not -(1 << (bits - 1)) <= x < 1 << (bits - 1):
        raise ValueError(f"{what} {x} does not fit {bits} bits")
    return x


def unlace(b: bytes, at: int, end: int, flags: int) -> tuple[str, list[tuple[int, int]]]:
    """The lacing's name and each frame's (offset, size)."""
    kind = flags & 0x06
    if not kind:
        return "none", [(at, end - at)]
    if at >= end:
        raise ValueError(f"lace without a count at byte {at}")
    n, at = b[at] + 1, at + 1
    if kind == 0x04:
        if (end - at) % n:
            raise ValueError(f"uneven fixed lace at byte {at}")
        sizes = [(end - at) // n] * n
    else:
        sizes = []
        for k in range(n - 1):
            if kind == 0x02:
                size = 0
                while True:
                    if at >= end:
                        raise ValueError(f"cut lace at byte {at}")
                    size, at = size + b[at], at + 1
                    if b[at - 1] != 255:
                        break
            else:
                v, at, width = read_vint(b, at, end)
                if v == UNKNOWN:
                    raise ValueError(f"unknown lace size at byte {at}")
                size = v if not k else sizes[-1] + v - ((1 << (7 * width - 1)) - 1)
            sizes.append(size)
        sizes.append(end - at - sum(sizes))
    if min(sizes) < 0 or sum(sizes) != end - at:
        raise ValueError(f"bad lace sizes at byte {at}")
    out = []
    for size in sizes:
        out.append((at, size))
        at += size
    return ("xiph" if kind == 0x02 else "fixed" if kind == 0x04 else "ebml"), out


def parse(b: bytes) -> Media:
    """Raises ValueError where the bytes are not a Matroska file."""
    doc_type, scale, duration, tracks, packets, cues, clusters = "", 10**6, None, [], [], [], []
    durations: dict[int, int] = {}
    n_block = 0

    def block(s: int, e: int, base: int, simple: bool, spread: int | None) -> None:
        nonlocal n_block
        track, at, _ = read_vint(b, s, e)
        if at + 3 > e:
            raise ValueError(f"cut block at byte {s}")
        time, flags = int.from_bytes(b[at : at + 2], "big", signed=True), b[at + 2]
        kind, frames = unlace(b, at + 3, e, flags)
        step = durations.get(track, 0) or (spread * scale // max(1, len(frames)) if spread else 0)
        for k, (o, n) in enumerate(frames):
            at_ns = _within((base + time) * scale + k * step, 64, "timestamp")
            packets.append(Packet(_within(track, 32, "track"), at_ns, o, n, len(clusters) - 1, n_block, kind, bool(flags & 0x80) if simple else spread is None or spread >= 0))
        n_block += 1

    found = False
    for i, s, e in elements(b, 0, len(b)):
        if i == EBML:
            doc_type = next((b[x:y].rstrip(b"\0").decode("ascii", "replace") for j, x, y in elements(b, s, e) if j == DOC_TYPE), "matroska")
        elif i == SEGMENT:
            found, origin = True, s
            for j, s1, e1 in elements(b, s, e):
                if j == INFO:
                    for k, x, y in elements(b, s1, e1):
                        if k == TIMESTAMP_SCALE:
                            scale = _uint(b, x, y)
                        elif k == DURATION:
                            duration = _real(b, x, y)
                elif j == TRACKS:
                    for k, x, y in elements(b, s1, e1):
                        if k != TRACK_ENTRY:
                            continue
                        t: dict = {"number": 0, "type": 0, "codec": "", "rate": 0.0, "channels": 1, "bits": 0}
                        for m, p, q in elements(b, x, y):
                            if m == TRACK_NUMBER:
                                t["number"] = _uint(b, p, q)
                            elif m == TRACK_TYPE:
                                t["type"] = _uint(b, p, q)
                            elif m == CODEC_ID:
                                t["codec"] = b[p:q].decode("ascii", "replace")
                            elif m == DEFAULT_DURATION:
                                t["duration_ns"] = _uint(b, p, q)
                            elif m == AUDIO:
                                for a, c, d in elements(b, p, q):
                                    if a == SAMPLING_FREQUENCY:
                                        t["rate"] = _real(b, c, d)
                                    elif a == CHANNELS:
                                        t["channels"] = _uint(b, c, d)
                                    elif a == BIT_DEPTH:
                                        t["bits"] = _uint(b, c, d)
                        tracks.append(t)
                        durations[t["number"]] = t.get("duration_ns", 0)
                elif j == CLUSTER:
                    clusters.append(s1)
                    base = 0
                    for k, x, y in elements(b, s1, e1):
                        if k == TIMESTAMP:
                            base = _uint(b, x, y)
                        elif k == SIMPLE_BLOCK:
                            block(x, y, base, True, None)
                        elif k == BLOCK_GROUP:
                            inner = {m: (p, q) for m, p, q in elements(b, x, y)}
                            if BLOCK in inner:
                                spread = _uint(b, *inner[BLOCK_DURATION]) if BLOCK_DURATION in inner else None
                                first = len(packets)
                                block(*inner[BLOCK], base, False, spread)
                                if REFERENCE in inner:
                                    packets[first:] = [p._replace(keyframe=False) for p in packets[first:]]
                elif j == CUES:
                    for k, x, y in elements(b, s1, e1):
                        if k != CUE_POINT:
                            continue
                        time, where = 0, []
                        for m, p, q in elements(b, x, y):
                            if m == CUE_TIME:
                                time = _uint(b, p, q)
                            elif m == CUE_TRACK_POSITIONS:
                                inner = {a: _uint(b, c, d) for a, c, d in elements(b, p, q)}
                                where.append((inner.get(CUE_TRACK, 0), origin + inner.get(CUE_CLUSTER_POSITION, 0)))
                        cues += [(time * scale, track, at) for track, at in where]
    if not found:
        raise ValueError("no segment")
    return Media(doc_type, scale, duration, tracks, packets, cues, clusters)


def samples(b: bytes, media: Media, track: int = 1) -> bytes:
    return b"".join([b[p.offset : p.offset + p.size] for p in media.packets if p.track == track])


def feature(b: bytes, media: Media, track: int = 1) -> str:
    """Counts of packets, blocks, clusters, cues that point at a cluster, laces; length; mean and RMS of the samples."""
    own = [p for p in media.packets if p.track == track]
    x = np.frombuffer(samples(b, media, track), np.uint8)
    good = sum(b.startswith(_id(CLUSTER), at) for _, _, at in media.cues)
    total, square = int(x.sum(dtype=np.int64)), int((x.astype(np.int64) ** 2).sum())
    n = max(1, x.size)
    return f"packets={len(own)};blocks={len({p.block for p in own})};clusters={len(media.clusters)};cues={good};laced={sum(p.lacing != 'none' for p in own)};ms={x.size * 1000 // RATE};mean={total / n:.4f};rms={(square / n) ** 0.5:.4f}"


# --- Spark

_PACKETS = "id long, track int, timestamp_ns long, offset long, size long, cluster int, block int, lacing string, keyframe boolean, error string"


def packet_table(df: DataFrame, id_col: str, media_col: str) -> DataFrame:
    """A row for each packet of each file; one with ``error`` set for bytes that don't parse. Null media give no row."""
    ready(df.sparkSession)
    schema = pa.schema([("id", pa.int64()), ("track", pa.int32()), ("timestamp_ns", pa.int64()), ("offset", pa.int64()), ("size", pa.int64()), ("cluster", pa.int32()), ("block", pa.int32()), ("lacing", pa.string()), ("keyframe", pa.bool_()), ("error", pa.string())])

    def run(batches):
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                if not raw.is_valid:
                    continue
                try:
                    rows = [(i, *p, None) for p in parse(raw.as_py()).packets]
                except ValueError as e:
                    rows = [(i, *[None] * 8, str(e))]
                if rows:
                    yield rows_to_batch(schema, list(zip(*rows)))

    return df.select(F.col(id_col).cast("long").alias("id"), F.col(media_col).cast("binary").alias("media")).mapInArrow(run, _PACKETS)


def payload_of(text: str) -> tuple[int, bytes]:
    raw = text.encode()
    return len(raw), raw + bytes(-len(raw) % 64 or (0 if raw else 64))


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])


def text_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns doc_id, n_bytes and media: each text's padded bytes as a Matroska file."""
    ready(df.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])

    def run(batches):
        for ids, texts in texts_of(batches):
            made = [payload_of(t) for t in texts]
            yield rows_to_batch(schema, [ids, [n for n, _ in made], [write(p) for _, p in made]])

    return id_text(df, id_col, text_col).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def media_digest(df: DataFrame) -> DataFrame:
    """Parses ``media`` of doc_id, n_bytes, media and gives the digests and features of what was read back; nulls
    for bytes that don't parse."""
    ready(df.sparkSession)

    def run(batches):
        for batch in batches:
            out = []
            for i, n, raw in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_bytes", "media"))):
                try:
                    media = parse(raw or b"")
                except ValueError:
                    out.append((i, n, *[None] * 6))
                    continue
                back = samples(raw, media)
                out.append((i, n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(raw), hashlib.sha256(raw).hexdigest(), feature(raw, media)))
            yield rows_to_batch(_DIGEST, list(zip(*out)) if out else [[]] * len(_DIGEST))

    return df.select("doc_id", "n_bytes", "media").mapInArrow(run, "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
