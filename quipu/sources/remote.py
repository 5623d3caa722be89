"""Driver-side helpers for sources on the web: link discovery, availability probes, verified downloads, archives."""

from __future__ import annotations

import fnmatch
import hashlib
import json
import os
import re
import urllib.error
import urllib.request
import zipfile
from collections.abc import Callable
from datetime import datetime, timezone
from urllib.parse import urljoin

CHUNK = 1 << 20
AGENT = {"User-Agent": "quipu (+public data research)"}


def download(url: str, dest: str, timeout: float = 120, opener: Callable = urllib.request.urlopen) -> dict:
    """Stream a file beside its place, move it there when whole, and leave its SHA-256 and size in a sidecar."""
    os.makedirs(os.path.dirname(dest) or ".", exist_ok=True)
    digest, size, part = hashlib.sha256(), 0, f"{dest}.part"
    with opener(urllib.request.Request(url, headers=AGENT), timeout=timeout) as source, open(part, "wb") as out:
        while chunk := source.read(CHUNK):
            out.write(chunk)
            digest.update(chunk)
            size += len(chunk)
    os.replace(part, dest)
    meta = {"url": url, "path": dest, "sha256": digest.hexdigest(), "bytes": size, "downloaded_at": datetime.now(timezone.utc).isoformat(timespec="seconds")}
    with open(f"{dest}.metadata.json", "w", encoding="utf-8") as f:
        json.dump(meta, f, ensure_ascii=False, indent=2)
    return meta


def probe(url: str, timeout: float = 30, opener: Callable = urllib.request.urlopen) -> dict:
    """Is a file there?  HEAD first; a host that refuses HEAD is asked for the first byte."""
    for method, headers in (("HEAD", {}), ("GET_RANGE", {"Range": "bytes=0-0"})):
        try:
            with opener(urllib.request.Request(url, headers=AGENT | headers, method=method.split("_")[0]), timeout=timeout) as r:
                return {"available": True, "http_status": r.status, "content_length": r.headers.get("Content-Length"), "probe_method": method}
        except urllib.error.HTTPError as e:
            status = e.code
        except (urllib.error.URLError, OSError) as e:
            return {"available": False, "error": type(e).__name__, "probe_method": "ERROR"}
    return {"available": False, "http_status": status, "probe_method": "GET_RANGE"}


def linked_years(html: str, base: str, pattern: str = r"/data/pagos-(\d{4})\.gz$") -> dict[int, str]:
    """Years and addresses of the links in a page that fit ``pattern``."""
    links = (urljoin(base, m[1]) for m in re.finditer(r"""<a\b[^>]*\bhref\s*=\s*["']([^"']+)["']""", html, re.I))
    return {int(m[1]): link for link in links if (m := re.search(pattern, link, re.I))}


def discover(pages: dict[str, str], years: range, address: Callable[[int], str], check: Callable[[str], dict] = probe) -> list[dict]:
    """A record per year: linked or not, available or not, or the probe failed.

    pages maps an address to its HTML; ``address`` gives where a year's file is
    expected if no page links it.
    """
    linked = {y: u for base, html in pages.items() for y, u in linked_years(html, base).items()}
    out = []
    for year in sorted({*linked, *years}):
        url = linked.get(year) or address(year)
        found = check(url)
        if found["available"]:
            status = "linked_available" if year in linked else "probed_available"
        else:
            status = "linked_unavailable" if year in linked else "probe_error" if "error" in found else "probed_missing"
        out.append({"year": year, "url": url, "status": status} | {k: v for k, v in found.items() if k != "available"})
    return out


def extract_members(archive: str, patterns: dict[str, str], folder: str) -> dict[str, str]:
    """The first member of a zip archive that fits each pattern, extracted under the pattern's name."""
    os.makedirs(folder, exist_ok=True)
    out = {}
    with zipfile.ZipFile(archive) as z:
        for name, pattern in patterns.items():
            member = next((m for m in sorted(z.namelist()) if fnmatch.fnmatch(os.path.basename(m).lower(), pattern.lower())), None)
            if member:
                out[name] = os.path.join(folder, f"{name}{os.path.splitext(member)[1]}")
                with z.open(member) as source, open(out[name], "wb") as target:
                    while chunk := source.read(CHUNK):
                        target.write(chunk)
    return out


def load_thresholds(path: str) -> dict:
    """A nested threshold file, JSON or (if a parser is installed) YAML; {} if there is none."""
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        if path.endswith(".json"):
            return json.load(f)
        try:
            import yaml
        except ImportError:
            return _two_levels(f.read())
        return yaml.safe_load(f) or {}


def _two_levels(text: str) -> dict:
    """Sections of ``key: value`` lines, which is all that threshold files use."""
    out: dict = {}
    section: dict = {}
    for line in text.splitlines():
        line = line.split("#")[0].rstrip()
        if not line:
            continue
        key, _, value = line.strip().partition(":")
        if not line[0].isspace():
            section = out.setdefault(key, {})
        else:
            value = value.strip()
            section[key] = {"true": True, "false": False}.get(value.lower(), float(value) if re.fullmatch(r"-?[\d.]+(e-?\d+)?", value) else value)
    return out
