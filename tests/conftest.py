from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

from gradeframe.session import build_session  # noqa: E402

SAMPLE_SCHEMA = (
    "id string, prompt string, reference string, model_output string, task_type string"
)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def samples(spark):
    """Eleven samples of both kinds; what they score follows from the formulas."""
    rows = [
        ("n01", "Where do ships anchor?", "harbour", " Harbour\n", "classification"),
        ("n02", "What does the map show?", "river delta", "river", "classification"),
        ("n03", "Tell what happened.", "seven ships left the port before dawn", "seven ships left before dawn", "generation"),
        ("n04", "改写。", "桥梁结构安全", "桥梁结构不安全", "generation"),
        ("n05", "Which metal?", "copper", "tin and zinc", "generation"),
        ("n06", "Say nothing.", "", "", "classification"),
        ("n07", "Say nothing.", "", "", "generation"),
        ("n08", "Colour of the flag?", "Blue", "blue", "classification"),
        ("n09", "Describe the wind.", "wind from the north west", "north", "generation"),
        ("n10", "Is it raining?", "yes", "no", "classification"),
        ("n11", "Count.", "one two three four five", "one two three four five", "generation"),
    ]
    return spark.createDataFrame(rows, SAMPLE_SCHEMA)


# Equal labels pass. ROUGE-L F1: n03 2*5/(5+7), n04 2*6/(7+6), n09 2*1/(1+5), n11 1.
PASSING = {"n01", "n03", "n04", "n06", "n08", "n11"}
EXPECTED_PASS = {f"n{i:02}": f"n{i:02}" in PASSING for i in range(1, 12)}
