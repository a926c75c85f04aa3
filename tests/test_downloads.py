"""Downloads over a client in memory: routes, retries, damage, names and orphans."""

import gzip
import hashlib

from tarnflow.sources import downloads as D

GOOD = gzip.compress(b"@r\nAC\n+\nII\n")
FILES = {
    "h/SRR1_1.fastq.gz": GOOD, "h/SRR1_2.fastq.gz": GOOD, "h/SRR1.fastq.gz": GOOD, "h/SRR2.fastq.gz": GOOD[:-6], "h/SRR3_1.fastq.gz": GOOD, "h/SRR3_2.fastq.gz": gzip.compress(b"@r\nAC\n"),
    "c/CRR5_f1.fq.gz": GOOD, "c/CRR5_r2.fq.gz": GOOD,
}


def memory():
    class Memory:
        """Fails at first for every address."""

        def __init__(self):
            self.asked = {}

        def download(self, url):
            self.asked[url] = self.asked.get(url, 0) + 1
            if self.asked[url] == 1:
                raise ConnectionError("try again")
            return FILES[url]

    return Memory()  # of a local class, which tasks can unpickle


def test_names_of_mates():
    assert [D.mate_name(n) for n in ("a_R1.fastq.gz", "a_r2.fq", "CRR5_f1.gz", "b_1.fastq.gz", "c.fastq", "d_R1_001.fastq.gz")] == [
        "a_1.fastq.gz", "a_2.fastq.gz", "CRR5_1.fastq.gz", "b_1.fastq.gz", "c.fastq.gz", "d_1.fastq.gz",
    ]


def test_downloads(spark, tmp_path):
    md5 = hashlib.md5(GOOD).hexdigest()
    runs = spark.createDataFrame([("SRR1",), ("SRR2",), ("SRR3",), ("SRR4",), ("CRR5",), ("XRR6",)], "run string")
    ena = spark.createDataFrame([(u.split("/")[1][:4], u, md5 if "SRR1" in u else None) for u in FILES if u.startswith("h/")], "run string, url string, md5 string")
    cncb = spark.createDataFrame([("CRR5", u, md5.upper()) for u in FILES if u.startswith("c/")], "run string, url string, md5 string")
    plan = D.download_files(runs, ena, cncb)
    assert {r.url for r in plan.collect() if r.run == "SRR1"} == {"h/SRR1_1.fastq.gz", "h/SRR1_2.fastq.gz"}
    done = D.downloaded(plan.coalesce(1), memory(), f"file://{tmp_path}/in", attempts=2, pause=0.0).collect()
    frame = spark.createDataFrame(done)
    assert {r.run: r.complete for r in D.run_states(frame).collect()} == {"SRR1": True, "SRR2": False, "SRR3": False, "SRR4": False, "CRR5": True, "XRR6": False}
    assert {p.name for p in (tmp_path / "in").iterdir()} == {"SRR1_1.fastq.gz", "SRR1_2.fastq.gz", "SRR3_1.fastq.gz", "CRR5_1.fastq.gz", "CRR5_2.fastq.gz"}
    assert D.without_orphans(frame, f"file://{tmp_path}/in") == 1 and not (tmp_path / "in" / "SRR3_1.fastq.gz").exists()

    class Never:
        def download(self, url):
            raise AssertionError(url)

    again = D.downloaded(plan.where("run = 'SRR1'"), Never(), f"file://{tmp_path}/in", attempts=1, pause=0.0).collect()
    assert [r.error for r in again] == [None, None]
    wrong = spark.createDataFrame([("SRR7", "ena", "h/SRR1.fastq.gz", "0" * 32)], "run string, archive string, url string, md5 string")
    assert "checksum" in D.downloaded(wrong, memory(), f"file://{tmp_path}/other", attempts=2, pause=0.0).first()["error"]
