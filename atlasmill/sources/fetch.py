"""Downloads that resume, boundaries from shapefiles, and filled templates: small files, on the driver."""

from __future__ import annotations

import os
import re
import struct
import urllib.error
import urllib.request


def download(url: str, path: str, tries: int = 5, chunk: int = 1 << 20) -> int:
    """Bytes of the file once it is whole. What a broken try has left in path.part is gone on with, by a range, if the server allows."""
    part = path + ".part"
    for left in reversed(range(tries)):
        have = os.path.getsize(part) if os.path.exists(part) else 0
        asked = urllib.request.Request(url, headers={"Range": f"bytes={have}-"} if have else {})
        try:
            with urllib.request.urlopen(asked, timeout=60) as got:
                resumed = have and got.status == 206
                whole = int(got.headers.get("Content-Length", -1)) + (have if resumed else 0)
                with open(part, "ab" if resumed else "wb") as f:
                    while block := got.read(chunk):
                        f.write(block)
            size = os.path.getsize(part)
            if size >= whole:
                os.replace(part, path)
                return size
        except urllib.error.HTTPError as e:
            if e.code == 416 and have:  # nothing is missing
                os.replace(part, path)
                return have
            if not left:
                raise
        except OSError:
            if not left:
                raise
    raise OSError(f"{url} broke off {tries} times")


def read_polygons(path: str) -> list[list[list[tuple[float, float]]]]:
    """Rings of each record of a shapefile of polygons; of null shapes none."""
    with open(path, "rb") as f:
        data = f.read()
    if struct.unpack_from(">i", data)[0] != 9994:
        raise ValueError(f"{path} is no shapefile")
    out, i = [], 100
    while i < len(data):
        _, words = struct.unpack_from(">ii", data, i)
        body = data[i + 8 : i + 8 + 2 * words]
        i += 8 + 2 * words
        (kind,) = struct.unpack_from("<i", body)
        if kind == 0:
            out.append([])
            continue
        if kind not in (5, 15, 25):
            raise ValueError(f"shape {kind} is no polygon")
        n, m = struct.unpack_from("<2i", body, 36)
        first = [*struct.unpack_from(f"<{n}i", body, 44), m]
        flat = struct.unpack_from(f"<{2 * m}d", body, 44 + 4 * n)
        points = list(zip(flat[::2], flat[1::2], strict=True))
        out.append([points[a:b] for a, b in zip(first, first[1:], strict=False)])
    return out


def boxes(shapes: list[list[list[tuple[float, float]]]], buffer: float = 0.0) -> list[tuple[float, float, float, float]]:
    """Coarse boxes around all shapes, one for each side of the map's middle line that any has."""
    east: dict[bool, list[tuple[float, float]]] = {}
    for rings in shapes:
        for ring in rings:
            east.setdefault(sum(x for x, _ in ring) >= 0, []).extend(ring)
    span = lambda ps: (min(x for x, _ in ps) - buffer, min(y for _, y in ps) - buffer, max(x for x, _ in ps) + buffer, max(y for _, y in ps) + buffer)
    return [span(east[k]) for k in sorted(east)]


def render(template: str, values: dict[str, object]) -> str:
    """A template's {{ name }} replaced; an error names those without a value."""
    names = set(re.findall(r"\{\{\s*(\w+)\s*\}\}", template))
    if names - values.keys():
        raise ValueError(f"no values for {sorted(names - values.keys())}")
    return re.sub(r"\{\{\s*(\w+)\s*\}\}", lambda m: str(values[m[1]]), template)
