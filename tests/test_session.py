import os
import subprocess
import sys

from salestax_spark.session import DEFAULTS, build_session

SUBMITTED = """
from salestax_spark.session import build_session
spark = build_session(**{"spark.ui.enabled": "false"})
assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
assert "spark.sql.adaptive.skewJoin.enabled" in spark.conf.getAll
spark.stop()
"""


def test_defaults(spark):
    assert {key: spark.conf.get(key) for key in DEFAULTS} == DEFAULTS


def test_an_existing_setting_is_kept(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert build_session().conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_submitted_setting_is_kept(monkeypatch):
    arguments = "--master local[1] --conf spark.sql.session.timeZone=Asia/Tokyo pyspark-shell"
    monkeypatch.setenv("PYSPARK_SUBMIT_ARGS", arguments)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", SUBMITTED], cwd=root, check=True, timeout=180)
