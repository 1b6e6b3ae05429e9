"""Optional adapters to live services. Nothing calls them by default; they need a network that tests don't have."""

from __future__ import annotations

import os
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import DataFrame

AGENT = {"User-Agent": "Mozilla/5.0 (compatible; linkforge)"}
TIMEOUT = 10


def call(url: str, method: str = "GET", headers: dict[str, str] | None = None, timeout: int = TIMEOUT, tries: int = 3, wait: float = 1.0):
    """The open response. Lost connections, 429 and 503 are tried again, after what Retry-After asks for or twice as long each time."""
    for k in range(tries):
        try:
            return urllib.request.urlopen(urllib.request.Request(url, method=method, headers={**AGENT, **(headers or {})}), timeout=timeout)
        except urllib.error.HTTPError as e:
            if e.code not in (429, 503) or k == tries - 1:
                raise
            asked = e.headers.get("Retry-After", "")
            time.sleep(float(asked) if asked.isdigit() else wait * 2**k)
        except (urllib.error.URLError, ConnectionError, TimeoutError):
            if k == tries - 1:
                raise
            time.sleep(wait * 2**k)


def download(url: str, path: str, chunk: int = 1 << 20) -> str:
    with call(url) as r, open(f"{path}.part", "wb") as f:
        while data := r.read(chunk):
            f.write(data)
    os.replace(f"{path}.part", path)
    return path


def refresh(url: str, folder: str) -> str:
    """The dump's local path, named by its Last-Modified date; downloaded only if it isn't there."""
    with call(url, "HEAD") as r:
        when = parsedate_to_datetime(r.headers["Last-Modified"])
    name, dot, rest = os.path.basename(url).partition(".")
    path = os.path.join(folder, f"{name}-{when:%Y%m%d%H%M%S}{dot}{rest}")
    return path if os.path.exists(path) else download(url, path)


def latest_musicbrainz(base: str) -> str:
    """base: the folder of full exports, which holds a file LATEST."""
    with call(f"{base}/LATEST") as r:
        return f"{base}/{r.read().decode().strip()}/mbdump.tar.bz2"


def discogs_dumps(listing: str) -> list[str]:
    """The newest artists and masters dumps of a bucket listing (XML)."""
    import re

    with call(listing) as r:
        keys = re.findall(r"<Key>([^<]+)</Key>", r.read().decode())
    newest = lambda kind: max(k for k in keys if k.endswith(f"_{kind}.xml.gz"))
    return [f"{listing.rstrip('/')}/{newest(k)}" for k in ("artists", "masters")]


def imdb_dumps(base: str) -> list[str]:
    return [f"{base}/title.basics.tsv.gz", f"{base}/name.basics.tsv.gz"]


def final_url(url: str) -> str | None:
    try:
        with call(url, tries=1) as r:
            return r.geturl()
    except Exception:  # noqa: BLE001  any failure means a dead link
        return None


def resolve(rows: DataFrame, url: str = "url") -> DataFrame:
    """rows with URLs replaced by where they lead; dead ones are dropped. Each distinct URL is fetched once."""

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in pdfs:
            yield pd.DataFrame({"asked": b["asked"], "final": [final_url(u) for u in b["asked"]]})

    found = rows.selectExpr(f"{url} as asked").distinct().mapInPandas(run, "asked string, final string").where("final is not null")
    return rows.join(found, rows[url] == found["asked"]).withColumn(url, found["final"]).drop("asked", "final")


def without_rotten(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(links that live, links that don't)."""
    alive = resolve(links.selectExpr("url as was", "url as to").distinct(), "to").select("was").distinct()
    return links.join(alive, links["url"] == alive["was"], "left_semi"), links.join(alive, links["url"] == alive["was"], "left_anti")


def totals(alive: DataFrame, rotten: DataFrame) -> DataFrame:
    """One row: how many links there were (total), how many of them live and how many don't (removed)."""
    both = alive.selectExpr("0 as gone").unionByName(rotten.selectExpr("1 as gone"))
    return both.selectExpr("count(*) as total", "coalesce(sum(1 - gone), 0) as alive", "coalesce(sum(gone), 0) as removed")
