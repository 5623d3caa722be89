"""The yearly source against a small web server and a folder."""

import hashlib
import http.server
import threading

import pytest

from quipu.sources import yearly

DATA = {1995: b"a" * 3_000_000 + b"end", 1996: b"short", 1998: b""}
ASKED = []


class Handler(http.server.BaseHTTPRequestHandler):
    def do_HEAD(self):
        self.answer(False)

    def do_GET(self):
        self.answer(True)

    def answer(self, body):
        year = int("".join(c for c in self.path if c.isdigit()) or 0)
        data, start = DATA.get(year), self.headers.get("Range")
        ASKED.append((self.command, year, start))
        if data is None:
            self.send_error(404)
            return
        first = int(start[6:].split("-")[0]) if start and year != 1996 else 0
        if start and first >= len(data) and year != 1996:
            self.send_error(416)
            return
        self.send_response(206 if first else 200)
        self.send_header("Content-Length", str(len(data) - first))
        self.end_headers()
        if body:
            self.wfile.write(data[first:])

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def web():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_states_and_digests_over_the_web(spark, web, tmp_path):
    yearly.register(spark)
    (tmp_path / "page.html").write_text(f'<p><a class="x" href="{web}/data/pagos-1996.gz">96</a><a href="/data/pagos-1997.gz">97</a><a href="/other">x</a>')
    read = spark.read.format("yearly_source").options(years="1994-1995,1998", address=web + "/data/pagos-{year}.gz", pages=f"file://{tmp_path}/page.html", base=web, folder=f"file://{tmp_path}/out")
    assert read.load().rdd.getNumPartitions() == 5
    rows = {r["year"]: r for r in read.load().collect()}
    assert {y: r["status"] for y, r in rows.items()} == {1994: "probed_missing", 1995: "downloaded", 1996: "downloaded", 1997: "linked_unavailable", 1998: "downloaded"}
    for y, data in DATA.items():
        assert (rows[y]["bytes"], rows[y]["sha256"]) == (len(data), hashlib.sha256(data).hexdigest())
        assert (tmp_path / "out" / f"{y}.gz").read_bytes() == data
    assert rows[1994]["http_status"] == 404 and rows[1995]["content_length"] == len(DATA[1995])
    before = len(ASKED)
    assert {r["year"]: r["sha256"] for r in read.load().collect() if r["bytes"] is not None} == {y: hashlib.sha256(d).hexdigest() for y, d in DATA.items()}
    assert all(method == "HEAD" for method, year, _ in ASKED[before:] if year in DATA)  # nothing is fetched twice
    only = spark.read.format("yearly_source").options(years="1995", address=web + "/{year}").load().first()
    assert only["status"] == "probed_available" and only["path"] is None


@pytest.mark.parametrize("year,part,start", [(1995, DATA[1995][:2_000_000], "bytes=2000000-"), (1995, DATA[1995], f"bytes={len(DATA[1995])}-"), (1996, b"sho", "bytes=3-")])
def test_a_broken_download_goes_on(web, tmp_path, year, part, start):
    (tmp_path / f"{year}.part-lost").write_bytes(part)
    (tmp_path / f"{year}.part-shorter").write_bytes(part[:1])
    got = yearly.fetch(f"{web}/data/{year}", f"file://{tmp_path}", str(year))
    assert got["sha256"] == hashlib.sha256(DATA[year]).hexdigest() and got["bytes"] == len(DATA[year])
    assert (tmp_path / f"{year}.data").read_bytes() == DATA[year] and ("GET", year, start) in ASKED


def test_years():
    assert yearly.years_of("1995-1997, 1990") == [1990, 1995, 1996, 1997]


def test_no_server(spark):
    yearly.register(spark)
    row = spark.read.format("yearly_source").options(years="1995", address="http://127.0.0.1:9/{year}").load().first()
    assert row["status"] == "probe_error" and row["error"]
