"""The pipeline from the command line: python -m leasemill --url PAGE --root FOLDER [--api URL --repository NAME --token-variable VARIABLE]."""

from __future__ import annotations

import argparse
import logging
import os
import sys
from datetime import date

from leasemill.plans import pipeline
from leasemill.session import build_session
from leasemill.sources.publish import from_token


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="leasemill", description="Download, load, report and publish rental contracts.")
    parser.add_argument("--url", required=True, help="page with the link to the CSV file")
    parser.add_argument("--root", required=True, help="folder of the artifacts")
    parser.add_argument("--day", type=date.fromisoformat, default=None, help="day of the artifacts, today if not given")
    parser.add_argument("--master", default=None, help="Spark master")
    parser.add_argument("--api", default=None, help="address of the service to publish at")
    parser.add_argument("--uploads", default=None, help="address for uploads, if another")
    parser.add_argument("--repository", default=None, help="repository of the releases; without it depositions are made")
    parser.add_argument("--token-variable", default="PUBLISH_TOKEN", help="environment variable with the token; if it is unset nothing is published")
    a = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO)
    publisher = from_token(os.environ.get(a.token_variable), a.api, a.uploads, a.repository) if a.api else None
    ok = pipeline.run(build_session("leasemill", a.master), a.url, a.root, a.day or date.today(), publisher)
    return 0 if ok else 1


if __name__ == "__main__":
    sys.exit(main())
