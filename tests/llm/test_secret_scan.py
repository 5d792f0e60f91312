import base64
import bz2
import gzip
import json
import lzma
import re
import urllib.parse
import zlib
from unittest import mock

import pytest
import zstandard
from edge import TEXTS, edge_docs, empty_docs
from pyspark.sql import functions as F

from ferrycraft.llm import secret_scan as s

SECRET = "token = 'AbCdEf123456'"


def plain_base(text):
    """The base rules as they are written."""
    out = []
    for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text,
                         re.IGNORECASE | re.ASCII):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(a, b, k) for a, k, b in sorted(out)]


@pytest.mark.parametrize("text", [
    "token=token:abcdefgh", "token=abc", "SECRET : \"abcdef\"", "tokens=abcdef", "api_key=a.b-c_d/e=", "apikey='x'",
    "password" + " " * 50 + "= hunter2hunter2", "AKIA" + "A1" * 8, "AKIA" + "A" * 15, "a" * 24 + "g" + "0" * 23, "",
    "tokeN=Keyabcdef ſecret=abcdefgh", "passwd==abcdefg passwd=passwd=abcdef", "x" * 10 + "f" * 1000])
def test_base_rules(text):
    assert s.scan(text)[0] == plain_base(text)


def encoded(text):
    raw = text.encode()
    b64 = lambda data: base64.b64encode(data).decode()
    return {
        "percent": urllib.parse.quote(text), "every character": "".join(f"%{b:02X}" for b in raw),
        "twice": urllib.parse.quote(urllib.parse.quote(text)), "json": "".join(f"\\u{ord(c):04x}" for c in text),
        "hex": "".join(f"\\x{b:02x}" for b in raw), "entity": "".join(f"&#{ord(c)};" for c in text),
        "base64": b64(raw), "url base64": base64.urlsafe_b64encode(raw + b"?>~").decode().rstrip("="), "nested": b64(b64(raw).encode()),
        "gzip": b64(gzip.compress(raw)), "zlib": b64(zlib.compress(raw)), "bz2": b64(bz2.compress(raw)),
        "xz": b64(lzma.compress(raw)), "zstd": b64(zstandard.compress(raw)),
        "deep": urllib.parse.quote(b64(gzip.compress(b64(zlib.compress(raw)).encode()))),
        "packed percent": "".join(f"%{b:02X}" for b in zlib.compress(raw))}


@pytest.mark.parametrize("how", list(encoded(SECRET)))
def test_layers(how):
    blob = encoded(SECRET)[how]
    text = f"é before {blob} after"
    base, spans, skipped = s.scan(text)
    assert base == plain_base(text) and set(base) <= set(spans) and skipped == 0
    found = [(a, b) for a, b, kind in spans if kind == 0]
    assert any(9 <= a and b <= 9 + len(blob) for a, b in found)


def test_span_of_partly_encoded_text():
    text = "see token%3Dabcdefg%2Fhij now"
    assert s.scan(text)[1] == [(4, 25, 0)] and text[4:25] == "token%3Dabcdefg%2Fhij"


def test_wrapped_base64():
    text = base64.encodebytes(("x " * 60 + SECRET).encode()).decode()
    assert any(kind == 0 for _, _, kind in s.scan(text)[1])


def test_cycles_end():
    """A stream that unwraps to itself is met once: the second time its place holds a text that was seen."""
    blob = base64.b64encode(b"z" * 30).decode()
    with mock.patch.object(s, "_content", lambda data, limit: blob):
        assert len(list(s.layers(f"x {blob} y"))) == 1
    assert len(list(s.layers("%2525252525"))) == 5


def test_large_layers_are_counted():
    bomb = base64.b64encode(zlib.compress(bytes(5_000_000), 9)).decode()
    assert s.scan(bomb, limit=1_000_000)[2] == 1


def test_masking(spark):
    df = spark.createDataFrame([(1, f"a {SECRET} b {SECRET}c"), (2, "nothing"), (3, SECRET)], "doc_id long, text string")
    out = s.scan_secrets(df, keep_text=True).select("doc_id", s.masked(F.col("text"), F.col("spans")).alias("t"))
    assert dict(out.collect()) == {1: "a [SECRET]' b [SECRET]'c", 2: "nothing", 3: "[SECRET]'"}


def test_edges(spark):
    out = {(r["doc_id"], json.dumps([list(x) for x in r["spans"]])) for r in s.scan_secrets(edge_docs(spark)).collect()}
    assert len(out) == len(TEXTS) + 1 and all(spans == "[]" for _, spans in out)
    assert s.scan_secrets(edge_docs(spark)).count() == len(TEXTS) + 2
    assert s.scan_secrets(empty_docs(spark)).count() == 0


PLAIN = "password=hunter2222"


def found(text, **options):
    return [(a, b) for a, b, kind in s.scan(text, **options)[1] if kind == 0]


@pytest.mark.parametrize("prefix", ["https://example.com/x/", "key_", "id-", "a/", "ab/", "abc/", "abcd+e_", "data:text/plain;base64,"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress])
def test_base64_behind_a_prefix(prefix, pack):
    blob = base64.b64encode(pack(PLAIN.encode())).decode()
    assert found(f"see {prefix}{blob} there")


@pytest.mark.parametrize("width", [4, 10, 11, 20, 47, 76])
@pytest.mark.parametrize("lead", ["", "    ", "> ", "> > ", '"'])
@pytest.mark.parametrize("pack", [bytes, zlib.compress, lzma.compress])
def test_base64_wrapped(width, lead, pack):
    blob = base64.b64encode(pack(b"x " * 30 + PLAIN.encode())).decode()
    end = '"' if lead == '"' else ""
    lines = "\n".join(f"{lead}{blob[i:i + width]}{end}" for i in range(0, len(blob), width))
    assert found(f"Dear all,\n{lines}\n\nBye.")


@pytest.mark.parametrize("data", ["café; password=hunter2222".encode("latin-1"), b"\0password=hunter2222", b"a\fpassword=hunter2222",
                                  b"\x1b[1mpassword=hunter2222", b"\xff" + base64.b64encode(PLAIN.encode())])
def test_base64_of_other_bytes(data):
    assert found("x " + base64.b64encode(data).decode())


def test_long_runs_end():
    import random
    import time
    start = time.time()
    data = random.Random(1).randbytes(1_000_000)
    s.scan(base64.b64encode(data).decode())
    s.scan(base64.encodebytes(data).decode())
    s.scan("word\n" * 200_000)
    assert time.time() - start < 30


@pytest.mark.parametrize("packs", [(gzip.compress,) * 3, (zlib.compress,) * 2, (bz2.compress,) * 2, (lzma.compress,) * 2, (zstandard.compress,) * 2, (gzip.compress, lzma.compress)])
def test_every_member(packs):
    data = b"".join(pack(b"nothing here. " * 9) for pack in packs) + packs[-1](PLAIN.encode())
    blob = base64.b64encode(data).decode()
    assert found(f"x {blob} y") and s.scan(blob)[2] == 0
    assert found("".join(f"%{b:02X}" for b in data))


def test_windows():
    data = b"a " * 50 + PLAIN.encode()
    assert found(base64.b64encode(lzma.compress(data, preset=9)).decode())
    wide = lzma.compress(data, filters=[{"id": lzma.FILTER_LZMA2, "dict_size": 1 << 30}])
    assert s.scan(base64.b64encode(wide).decode())[2] == 1
    params = zstandard.ZstdCompressionParameters.from_level(3, window_log=30)
    engine = zstandard.ZstdCompressor(compression_params=params).compressobj()
    wide = engine.compress(b"abc " * 300_000 + data) + engine.flush()
    assert s.scan(base64.b64encode(wide).decode())[2] == 1


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress])
@pytest.mark.parametrize("at", [100, 999_995, 1_499_990, 2_000_000, 4_999_000])
def test_long_streams_are_scanned_whole(pack, at):
    data = bytearray(b"ab " * 1_700_000)
    data[at:at + len(PLAIN) + 2] = f" {PLAIN} ".encode()
    blob = base64.b64encode(pack(bytes(data))).decode()
    assert found(blob, limit=1_000_000) and s.scan(blob, limit=1_000_000)[2] == 1
