"""The paginated crawl against a loop over the pages, from a local server."""

import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from test_sources import item

from gridloom.sources import crawl as C

SITES = {
    "dry": {1: [1, 2], 2: [2, 3], 3: [3], 4: [4], 5: [4], 6: [1, 2], 7: [5], 8: [6]},  # two dry pages in a row: 5 and 6
    "gone": {1: [1], 2: [2], 3: [3], 5: [5]},
    "all": {n: [n % 9 + 1] for n in range(1, 8)},
}


@pytest.fixture(scope="module")
def server():
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            url = urlparse(self.path)
            page, site = int(parse_qs(url.query).get("paged", ["1"])[0]), SITES[url.path.strip("/")]
            asked.append((url.path.strip("/"), page))
            self.send_response(200 if page in site else 404)
            self.end_headers()
            self.wfile.write("".join(item(n) for n in site.get(page, [])).encode())

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", asked
    server.shutdown()


def loop(site, most):
    """(report, page) as a loop over the pages meets them."""
    seen, dry, out = set(), 0, []
    for page in range(1, most + 1):
        if page not in site:
            break
        new = [r for r in site[page] if r not in seen]
        seen |= set(new)
        dry = 0 if new else dry + 1
        if dry >= 2:
            break
        out += [(r, page) for r in new]
    return out


@pytest.mark.parametrize("name, window, furthest", [("dry", 2, 6), ("dry", 5, 8), ("dry", 8, 8), ("gone", 2, 4), ("gone", 3, 6), ("all", 3, 7)])
def test_equal_to_a_loop(spark, tmp_path, server, name, window, furthest):
    address, asked = server
    asked.clear()
    most = 7 if name == "all" else 8
    got = C.crawl_archive(spark, f"{address}/{name}", str(tmp_path), most_pages=most, window=window)
    rows = [(int(r.report_url.rsplit("/", 1)[1]), r.source_page) for r in got.orderBy("source_page", "report_url").collect()]
    assert rows == sorted(loop(SITES[name], most), key=lambda r: (r[1], r[0]))
    assert sorted(asked) == [(name, n) for n in range(1, furthest + 1)]  # each page once, none beyond the window of the stop


def test_pages_are_partitions_and_addresses_follow_the_archive(spark):
    spark.dataSource.register(C.page_source(lambda url: url.encode()))
    pages = spark.read.format("archive_pages").options(archive="https://a.example/list?x=1", first="1", last="3").load()
    assert pages.rdd.getNumPartitions() == 3
    assert [(r.page_no, r.html, r.error) for r in pages.orderBy("page_no").collect()] == [(1, "https://a.example/list?x=1", None), (2, "https://a.example/list?x=1&paged=2", None), (3, "https://a.example/list?x=1&paged=3", None)]
    assert C.page_url("https://a.example/list", 7) == "https://a.example/list?paged=7"


def test_a_broken_first_page_gives_no_reports(spark, tmp_path):
    def get(url):
        raise OSError("down")

    assert C.crawl_archive(spark, "https://a.example/list", str(tmp_path), get, most_pages=3).count() == 0
