"""Publication of finished artifacts: an interface, a folder and two REST services of a common shape."""

from __future__ import annotations

import contextlib
import json
import logging
import shutil
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable
from pathlib import Path
from typing import Protocol

log = logging.getLogger(__name__)


class Publisher(Protocol):
    def exists(self, tag: str) -> bool | None: ...

    def publish(self, tag: str, files: Iterable[str]) -> str: ...


def pieces(files: Iterable[str]) -> list[tuple[str, Path]]:
    """Name and file of all that is to be uploaded. A folder, as Spark writes tables, stands for every file of data in it, its
    path joined by ``-`` to one name; marks and checksums (names that begin with ``_`` or ``.``) are no data. A folder
    without data and names that clash raise OSError, before anything is sent."""
    out = []
    for f in map(Path, files):
        if not f.is_dir():
            out.append((f.name, f))
            continue
        inside = [(p.relative_to(f), p) for p in sorted(f.rglob("*")) if p.is_file()]
        data = [("-".join((f.name, *rel.parts)), p) for rel, p in inside if not any(part[0] in "_." for part in rel.parts)]
        if not data:
            raise OSError(f"{f} holds no data")
        out += data
    names = [name for name, _ in out]
    if len(set(names)) < len(names):
        raise OSError(f"names clash: {sorted({n for n in names if names.count(n) > 1})}")
    return out


class FolderPublisher:
    """Copies artifacts to <root>/<tag>."""

    def __init__(self, root: str):
        self.root = Path(root)

    def exists(self, tag: str) -> bool:
        return (self.root / tag).is_dir()

    def publish(self, tag: str, files: Iterable[str]) -> str:
        target = self.root / tag
        target.mkdir(parents=True, exist_ok=True)
        for f in files:
            source = Path(f)
            if source.is_dir():
                shutil.copytree(source, target / source.name, dirs_exist_ok=True)
            else:
                shutil.copy2(source, target / source.name)
        return str(target)


Send = Callable[[str, str, dict, bytes | Path | None], tuple[int, bytes]]


def send(method: str, url: str, headers: dict, body: bytes | Path | None) -> tuple[int, bytes]:
    """Send a request; the content of a file goes as a stream."""
    with contextlib.ExitStack() as opened:
        if isinstance(body, Path):
            headers = headers | {"Content-Length": str(body.stat().st_size)}
            body = opened.enter_context(body.open("rb"))
        request = urllib.request.Request(url, data=body, headers=headers, method=method)
        try:
            with urllib.request.urlopen(request, timeout=60) as r:
                return r.status, r.read()
        except urllib.error.HTTPError as e:
            return e.code, e.read()


class ReleasePublisher:
    """Releases of a code host: create by tag, then upload assets. A failed upload is logged and the rest goes on; ``missing``
    has the names that the last upload did not bring. Such a release stays, and counts as existing, until it is deleted."""

    def __init__(self, api: str, uploads: str, repository: str, token: str, http: Send = send):
        self.api, self.uploads, self.repository, self.http = api.rstrip("/"), uploads.rstrip("/"), repository, http
        self.headers = {"Authorization": f"Bearer {token}", "Accept": "application/json"}
        self.missing: list[str] = []

    def exists(self, tag: str) -> bool | None:
        status, _ = self.http("GET", f"{self.api}/repos/{self.repository}/releases/tags/{tag}", self.headers, None)
        return {200: True, 404: False}.get(status)

    def create(self, tag: str, text: str = "") -> int:
        body = json.dumps({"tag_name": tag, "name": tag, "body": text}).encode()
        status, data = self.http("POST", f"{self.api}/repos/{self.repository}/releases", self.headers, body)
        if status != 201:
            raise OSError(f"release {tag} was not created: {status}")
        return json.loads(data)["id"]

    def upload(self, release: int, files: Iterable[str]) -> list[str]:
        done, self.missing = [], []
        for name, file in pieces(files):
            url = f"{self.uploads}/repos/{self.repository}/releases/{release}/assets?name={urllib.parse.quote(name)}"
            try:
                status, _ = self.http("POST", url, self.headers | {"Content-Type": "application/octet-stream"}, file)
                if status != 201:
                    raise OSError(status)
                done.append(name)
            except OSError as e:
                log.error("upload of %s failed: %s", name, e)
                self.missing.append(name)
        return done

    def publish(self, tag: str, files: Iterable[str]) -> str:
        files = list(files)
        pieces(files)
        release = self.create(tag)
        if not self.upload(release, files):
            raise OSError(f"nothing was uploaded to {tag}")
        return str(release)


class DepositPublisher:
    """Depositions of a data archive: list, create, upload, publish, delete. If an upload fails, the draft is deleted."""

    def __init__(self, api: str, token: str, http: Send = send):
        self.api, self.http = api.rstrip("/"), http
        self.headers = {"Authorization": f"Bearer {token}", "Content-Type": "application/json"}

    def _call(self, method: str, path: str, body: bytes | Path | None = None, ok=(200, 201, 202, 204), headers: dict | None = None):
        url = path if path.startswith("http") else f"{self.api}/{path}"
        status, data = self.http(method, url, headers or self.headers, body)
        if status not in ok:
            raise OSError(f"{method} {path}: {status}")
        return json.loads(data) if data else None

    def list(self) -> list[dict]:
        return self._call("GET", "deposit/depositions") or []

    def create(self, metadata: dict) -> dict:
        return self._call("POST", "deposit/depositions", json.dumps({"metadata": metadata}).encode())

    def upload(self, bucket: str, file: str) -> None:
        for name, piece in pieces([file]):
            self._call("PUT", f"{bucket}/{urllib.parse.quote(name)}", piece, headers=self.headers | {"Content-Type": "application/octet-stream"})

    def release(self, deposition: int) -> dict:
        return self._call("POST", f"deposit/depositions/{deposition}/actions/publish")

    def delete(self, deposition: int) -> None:
        """Delete a draft; a deposition that is published stays, and that is an error."""
        if self._call("GET", f"deposit/depositions/{deposition}").get("submitted"):
            raise OSError(f"deposition {deposition} is published and cannot be deleted")
        self._call("DELETE", f"deposit/depositions/{deposition}")

    def exists(self, tag: str) -> bool:
        return any(d.get("title") == tag for d in self.list())

    def publish(self, tag: str, files: Iterable[str]) -> str:
        files = list(files)
        pieces(files)
        made = self.create({"title": tag, "upload_type": "dataset", "description": tag})
        try:
            for f in files:
                self.upload(made["links"]["bucket"], f)
        except OSError:
            self.delete(made["id"])
            raise
        self.release(made["id"])
        return str(made["id"])


def publish_existing(publisher: Publisher | None, tag: str, files: Iterable[str]) -> str | None:
    """Publish those artifacts that exist, if there is a publisher and the tag is new."""
    there = [f for f in files if Path(f).exists()]
    if publisher is None or not there or publisher.exists(tag):
        return None
    return publisher.publish(tag, there)


def from_token(token: str | None, api: str, uploads: str | None = None, repository: str | None = None, http: Send = send) -> Publisher | None:
    """The publisher for a token: releases of ``repository``, or depositions where none is named; None without a token."""
    if not token:
        return None
    return ReleasePublisher(api, uploads or api, repository, token, http) if repository else DepositPublisher(api, token, http)
