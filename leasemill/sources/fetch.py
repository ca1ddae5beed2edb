"""Download of the source file: a page names it, the file is streamed to disk. Driver-side, outside any query plan."""

from __future__ import annotations

import logging
import os
import time
import urllib.parse
import urllib.request
from collections.abc import Callable
from html.parser import HTMLParser
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

from leasemill.settings import FETCH_BACKOFF_BASE, FETCH_CHUNK_BYTES, FETCH_RETRIES, FETCH_TIMEOUT_S

log = logging.getLogger(__name__)

#: Fixed value: the class of the link to the file.
LINK_CLASS = "action-icon-anchor"


class _LinkFinder(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found, self.href = False, None

    def handle_starttag(self, tag, attrs):
        a = dict(reversed(attrs))  # of an attribute that is given twice the first counts
        if tag == "a" and not self.found and LINK_CLASS in (a.get("class") or "").split():
            self.found, self.href = True, a.get("href") or None


def find_link(html: bytes | str) -> str | None:
    """``href`` of the page's first download link, or None."""
    finder = _LinkFinder()
    finder.feed(html.decode("utf-8", "replace") if isinstance(html, bytes) else html)
    return finder.href


#: An attribute with its value, if any, and what may stand before the first attribute of a certain name.
_ATTRIBUTE = r"""[^\s"'>/=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*))?"""
_BEFORE = rf"(?is)\A<a(?:[\s/]+{_ATTRIBUTE})*?[\s/]+"
_VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))"""
#: What of a page is no mark-up: comments, scripts and styles.
_NO_TAGS = r"(?is)<!--.*?-->|<(script|style)\b.*?</\1\s*>"


def _attribute(tag: Column, name: str) -> Column:
    """The value of a tag's first attribute of that name; empty if there is none."""
    return F.concat(*[F.regexp_extract(tag, _BEFORE + name + _VALUE, i) for i in (1, 2, 3)])


def link_column(html: Column) -> Column:
    """The same over a column of pages, JVM-side; null for a page without such a link."""
    tags = F.regexp_extract_all(F.regexp_replace(html, _NO_TAGS, ""), F.lit(r"""(?is)(<a(?=[\s/>])(?:[^>"']|"[^"]*"|'[^']*')*>)"""), 1)
    ours = F.filter(tags, lambda t: F.array_contains(F.split(_attribute(t, "class"), r"\s+"), LINK_CLASS))
    href = _attribute(F.try_element_at(ours, F.lit(1)), "href")
    for entity, character in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        href = F.replace(href, F.lit(entity), F.lit(character))
    return F.nullif(href, F.lit(""))


def with_retries(action: Callable[[], object], attempts: int = FETCH_RETRIES, sleep: Callable[[float], None] = time.sleep):
    """The action's result; OSErrors (network errors are) are tried again after 1, 2, 4 ... seconds, the last is raised."""
    for attempt in range(attempts):
        try:
            return action()
        except OSError as e:
            log.warning("attempt %d of %d failed: %s", attempt + 1, attempts, e)
            if attempt + 1 == attempts:
                raise
            sleep(FETCH_BACKOFF_BASE**attempt)


def fetch_page(url: str, opener=urllib.request.urlopen, sleep=time.sleep) -> bytes:
    def get() -> bytes:
        with opener(url, timeout=FETCH_TIMEOUT_S) as response:
            return response.read()

    return with_retries(get, sleep=sleep)


def download_file(url: str, target: str, opener=urllib.request.urlopen, sleep=time.sleep) -> int:
    """Stream a file to disk; the target appears only when it is whole. Returns its bytes."""
    Path(target).parent.mkdir(parents=True, exist_ok=True)
    part = f"{target}.part"

    def get() -> int:
        size = 0
        with opener(url, timeout=FETCH_TIMEOUT_S) as response, open(part, "wb") as out:
            while chunk := response.read(FETCH_CHUNK_BYTES):
                size += out.write(chunk)
        return size

    size = with_retries(get, sleep=sleep)
    os.replace(part, target)
    return size


def download_contracts(page_url: str, target: str, opener=urllib.request.urlopen, sleep=time.sleep) -> bool:
    """Page, link, file. A target that is already there is left alone; any failure gives False."""
    if Path(target).exists():
        return True
    try:
        link = find_link(fetch_page(page_url, opener, sleep))
        if not link:
            log.error("no download link at %s", page_url)
            return False
        download_file(urllib.parse.urljoin(page_url, link), target, opener, sleep)
        return True
    except Exception:
        log.exception("download from %s failed", page_url)
        return False
