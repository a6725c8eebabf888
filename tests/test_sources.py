import http.server
import struct
import threading
import zlib

import pytest

from atlasmill.sources import fetch, pbf


def varint(n):
    out = b""
    while n > 127:
        out += bytes([n & 127 | 128])
        n >>= 7
    return out + bytes([n])


def field(k, v):
    return varint(k << 3) + varint(v) if isinstance(v, int) else varint(k << 3 | 2) + varint(len(v)) + v


def zigzag(n):
    return n << 1 if n >= 0 else (-n << 1) - 1


def deltas(values):
    return b"".join(varint(zigzag(b - a)) for a, b in zip([0, *values], values, strict=False))


def blob(kind, data, squeeze=True):
    body = field(2, len(data)) + field(3, zlib.compress(data)) if squeeze else field(1, data)
    head = field(1, kind) + field(3, len(body))
    return struct.pack(">I", len(head)) + head + body


def test_pbf(spark, tmp_path):
    texts = [b"", b"shop", b"bakery", b"name", "Brød".encode(), b"cafe"]
    table = b"".join(field(1, t) for t in texts)
    info = field(1, varint(1) + varint(2) + varint(3)) + field(2, deltas([10, 20, 30])) + field(6, varint(1) + varint(1) + varint(0))
    dense = field(1, deltas([5, 5, 5])) + field(5, info) + field(8, deltas([476000000, 476000010, 0])) + field(9, deltas([-1223000000, -1223000000, 0]))
    dense += field(10, varint(1) + varint(2) + varint(0) + varint(1) + varint(5) + varint(3) + varint(4) + varint(0) + varint(0))
    corner = lambda i, x, y: field(1, zigzag(i)) + field(8, zigzag(y)) + field(9, zigzag(x))
    way = field(1, 9) + field(2, varint(1)) + field(3, varint(2)) + field(4, field(1, 4) + field(2, 40)) + field(8, deltas([21, 22, 23, 21]))
    relation = field(1, 11) + field(9, deltas([9, 4])) + field(8, varint(0) * 2) + field(10, varint(1) * 2)
    group = [field(2, dense), b"".join(field(1, corner(*p)) for p in ((21, 0, 0), (22, 30000000, 0), (23, 0, 30000000))), field(3, way), field(4, relation)]
    blocks = [field(1, table) + b"".join(field(2, g) for g in group[:2]), field(1, table) + b"".join(field(2, g) for g in group[2:])]
    (tmp_path / "a.pbf").write_bytes(blob(b"OSMHeader", b"") + blob(b"OSMData", blocks[0]) + blob(b"OSMData", blocks[1], False))
    rows = pbf.read_pbf(spark, f"file://{tmp_path}/a.pbf")
    got = {(r.type, r.id, r.version): r for r in rows.collect()}
    assert set(got) == {("node", 5, 1), ("node", 5, 2), ("node", 5, 3), ("node", 21, None), ("node", 22, None), ("node", 23, None), ("way", 9, 4), ("relation", 11, None)}
    one, two = got["node", 5, 1], got["node", 5, 2]
    assert (one.lat, one.lon, one.tags, one.timestamp.second) == (pytest.approx(47.6), pytest.approx(-122.3), {"shop": "bakery"}, 10) and two.tags == {"shop": "cafe", "name": "Brød"}
    assert not got["node", 5, 3].visible and got["way", 9, 4].refs == [21, 22, 23, 21] and got["relation", 11, None].refs == [9, 4]
    told = {(r.version, r.key): (r.value, r.change) for r in pbf.changes(rows.where("type = 'node' AND id = 5")).collect()}
    assert told == {(1, "shop"): ("bakery", "Added"), (2, "shop"): ("cafe", "Changed"), (2, "name"): ("Brød", "Added"), (3, "shop"): (None, "Deleted"), (3, "name"): (None, "Deleted")}
    places = {(r.type, r.id): (r.lat, r.lon) for r in pbf.tagged_places(rows.where("version IS NULL OR version <> 1"), ["shop"]).collect()}
    assert places == {("node", 5): (pytest.approx(47.600001), pytest.approx(-122.3)), ("way", 9): (pytest.approx(1.0), pytest.approx(1.0))}


def test_shapefile(tmp_path):
    rings = [[(0, 0), (0, 2), (2, 2), (0, 0)], [(-9, 1), (-8, 1), (-8, 3), (-9, 1)]]
    points = [p for r in rings for p in r]
    body = struct.pack("<i4d2i", 5, -9, 0, 2, 3, 2, len(points)) + struct.pack("<2i", 0, 4) + b"".join(struct.pack("<2d", *p) for p in points)
    records = struct.pack(">2i", 1, len(body) // 2) + body + struct.pack(">2i", 2, 2) + struct.pack("<i", 0)
    (tmp_path / "s.shp").write_bytes(struct.pack(">i", 9994) + bytes(96) + records)
    shapes = fetch.read_polygons(str(tmp_path / "s.shp"))
    assert shapes == [rings, []] and fetch.boxes(shapes, 0.5) == [(-9.5, 0.5, -7.5, 3.5), (-0.5, -0.5, 2.5, 2.5)]


def test_downloads_resume(tmp_path):
    data = bytes(range(256)) * 400
    asked = []

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            at = int(self.headers["Range"][6:-1]) if "Range" in self.headers else 0
            asked.append(at)
            self.send_response(206 if at else 200)
            self.send_header("Content-Length", str(len(data) - at))
            self.end_headers()
            self.wfile.write(data[at : at + 40_000])  # and breaks off

        def log_message(self, *a):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        assert fetch.download(f"http://127.0.0.1:{server.server_port}/x", str(tmp_path / "x")) == len(data)
    finally:
        server.shutdown()
    assert (tmp_path / "x").read_bytes() == data and asked == [0, 40_000, 80_000] and not (tmp_path / "x.part").exists()


def test_templates():
    assert fetch.render("v{{ a }} of {{b}}", {"a": 1, "b": "x", "c": 2}) == "v1 of x"
    with pytest.raises(ValueError):
        fetch.render("{{ a }}", {})
