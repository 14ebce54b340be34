"""Texts whose parts are too long for Python's own conversions."""

import hashlib
import time

from tests.llm.test_contracts import answers, frame
from tidelog.llm import pii, secret_scan


def test_ip_part_of_very_many_zeros(spark):
    zeros = "0" * 5000
    rows = [(1, f"{zeros}.2.3.4"), (2, f"{zeros}256.2.3.4")]
    listed = hashlib.sha256(b"ip:0:5006").hexdigest()
    got = answers(pii.find(frame(spark, rows)), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert got == [(1, 0, 1, 0, 0, listed), (2, 0, 0, 0, 0, hashlib.sha256(b"").hexdigest())]


def test_long_runs_take_linear_time(spark):
    rows = [(1, "7" * 1_000_000), (2, "eyJ" * 350_000 + " token"), (3, "1." * 300_000), (4, "eyJabcdefgh.eyJabcdefgh.xyz")]
    began = time.monotonic()
    assert [r[1:5] for r in answers(pii.find(frame(spark, rows[:3])), "doc_id", "n_email", "n_ip", "n_card", "n_phone")][0] == (0, 0, 0, 0)
    found = answers(secret_scan.scan(frame(spark, rows)), "doc_id", "spans")
    assert time.monotonic() - began < 60
    assert found[1] == (2, "") and found[3] == (4, "jwt:0:27")
