import os
import sys
import zipfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


HEADER = "".join(f"header line {i}\n" for i in range(19)) + "\n"  # the twentieth line is blank
STATION_TEXT = (
    "EUROPEAN CLIMATE ASSESSMENT\n\nSTAID,STANAME                                 ,CN,      LAT,       LON,HGHT\n"
    "-----\n"
    "    1,VAEXJOE                                 ,SE,+56:52:00,+014:48:00, 166\n"
    "  257,LONDON                                  ,GB,+51:30:26,-000:07:39,  35\n"
    "  300,SHORT,GB\n"
    "  258,DUBLIN                                  ,GB,53.5,-6.25,-999\n"
    "  257,LONDON AGAIN                            ,GB,+51:30:26,-000:07:39,\n"
)
ELEMENT_TEXT = "ELEID,DESC,UNIT\n\nTX1 ,maximum,0.1 C\nTN4,minimum,0.1 C\nQQ1,radiation,W/m2\n"


def station_file(rows):
    return HEADER + "".join(f"{r}\n" for r in rows)


@pytest.fixture
def make_zip():
    def make(path, files):
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for name, text in files.items():
                z.writestr(name, text)
        return str(path)

    return make


def rows(df, *columns):
    return sorted(
        (tuple(r[c] for c in (columns or df.columns)) for r in df.collect()), key=lambda t: tuple(map(str, t))
    )
