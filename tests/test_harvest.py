"""The metadata harvest over recorded answers: searches, links, verification, states, resuming and keyword search."""

import json

import pytest

from tarnflow.pipeline import metadata_harvest as H
from tarnflow.sources import archives as A

HEAD = "Run,BioProject,BioSample,LibraryLayout"


def sample(n, accession, uid, host):
    return f'{n}: Sample {accession}\nIdentifiers: BioSample: {accession}\nOrganism: soil metagenome\nAttributes:\n    /host="{host}"\nKeywords: GSC:MIxS\nAccession: {accession}\tID: {uid}\n'


ANSWERS = {
    "search": {
        "sra PRJNA1[BioProject]": ["1", "2"], "sra PRJNA2[BioProject]": ["3"], "sra PRJNA4[BioProject]": "!archive is down",
        "bioproject PRJNA1[Project Accession]": ["101", "999"],
        "biosample SAMN9[Accession]": ["9"], "biosample SAMD10[Accession]": ["77"], "biosample SAMD10": ["78", "10"], "biosample SAMD11[Accession]": ["77"],
        'bioproject ("gut") AND ("mouse")': ["p1", "p2"], 'bioproject ("gut") AND ("man")': ["p2"],
    },
    "link": {"bioproject biosample 101": ["51", "52", "51"], "biosample sra 9": ["4"], "biosample sra 10": ["5"]},
    "summary": {"biosample 9": "SAMN9", "biosample 77": "SAMN10", "biosample 78": "SAMX", "biosample 10": "SAMD10"},
    "fetch": {
        "sra runinfo 1": f"{HEAD}\nSRR1,PRJNA77,SAMN51,PAIRED\n", "sra runinfo 2": f"{HEAD}\nSRR2,PRJNA77,SAMN53,SINGLE\n", "sra runinfo 3": f"{HEAD}\nnot a run,PRJNA2,SAMN60,PAIRED\n",
        "sra runinfo 4": f"{HEAD}\nSRR9,PRJNA8,SAMN9,PAIRED\n", "sra runinfo 5": f"{HEAD}\nDRR10,PRJDB8,SAMN10,PAIRED\n",
        "biosample full 51": sample(1, "SAMN51", 51, "mouse"), "biosample full 52": sample(2, "SAMN52", 52, "rat"), "biosample full 9": sample(1, "SAMN9", 9, "ant"), "biosample full 10": sample(2, "SAMN10", 10, "bee"),
        "cncb runinfo PRJCA5": 'Run,BioProject,BioSample,Title\nCRR5,PRJCA5,SAMC5,"a, b"\n',
        "bioproject xml p1": "<DocumentSummary><Project><ProjectID><ArchiveID accession='PRJNA1'/></ProjectID><ProjectDescr><Title>A &amp; B</Title></ProjectDescr><OrganismName>mouse gut</OrganismName></Project></DocumentSummary>",
        "bioproject xml p2": '<DocumentSummary><Project><ProjectID><ArchiveID archive="NCBI" accession="PRJNA3"/></ProjectID><ProjectDescr><Title>T</Title><Description>D</Description></ProjectDescr></Project></DocumentSummary>',
        'cncb search ("gut") AND ("man")': "Accession\tTitle\tDescription\tSpecies\nPRJCA5\tt\td\thuman\nbroken line\nXX1\tt\td\ts\n",
    },
}


@pytest.fixture(scope="module")
def client(tmp_path_factory):
    folder = tmp_path_factory.mktemp("archive")
    for kind, answers in ANSWERS.items():
        (folder / f"{kind}.json").write_text(json.dumps(answers))
    return A.RecordedArchive(str(folder))


def test_batches_and_verification(spark, client):
    found = spark.createDataFrame([("g", [str(i) for i in range(7)]), ("h", []), ("i", None)], "project string, uids array<string>")
    rows = sorted((r.project, r.batch, r.ids) for r in A.in_batches(found, "project", 3).collect())
    assert rows == [("g", 0, ["0", "1", "2"]), ("g", 1, ["3", "4", "5"]), ("g", 2, ["6"])]
    ids = spark.createDataFrame([("SAMN9",), ("SAMD10",), ("SAMD11",)], "id string")
    assert {r.id: r.uid for r in A.verified_uids(ids, client).collect()} == {"SAMN9": "9", "SAMD10": "10", "SAMD11": None}


def test_harvest_with_states_and_resuming(spark, client, tmp_path):
    names = ["PRJNA1", "PRJNA2", "PRJNA3", "PRJNA4", "PRJCA5", "what", "SAMN9", "SAMD10", "SAMD11"]
    ids = spark.createDataFrame([(n,) for n in names], "id string")
    out = H.harvest_study(spark, client, ids, str(tmp_path))
    assert {r.id: r.status for r in out["status"].collect()} == {
        "PRJNA1": "has_data", "PRJNA2": "no_run_info", "PRJNA3": "no_data", "PRJNA4": "download_error", "PRJCA5": "has_data", "what": "invalid_format",
        "SAMN9": "has_data", "SAMD10": "has_data", "SAMD11": "no_data",
    }
    rows = {r.Run: r for r in out["table"].collect()}
    # Runs, samples without runs, and runs without samples; the asked project and sample stand in for the archive's own.
    assert set(rows) == {"SRR1", "SRR2", None, "CRR5", "SRR9", "DRR10"}
    assert (rows["SRR1"].BioProject, rows["SRR1"].host, rows["SRR2"].host, rows[None].BioSample) == ("PRJNA1", "mouse", None, "SAMN52")
    assert (rows["DRR10"].BioSample, rows["DRR10"].host, rows["CRR5"].SourceDatabase) == ("SAMD10", "bee", "CNCB")

    class Silent(A.RecordedArchive):
        """Nothing that is complete may be asked for again."""

        def search(self, db, term):
            assert not any(x in term for x in ("PRJNA1", "SAMN9", "SAMD10")), term
            return super().search(db, term)

    again = H.harvest_study(spark, Silent(client.folder), ids, str(tmp_path))
    assert again["table"].count() == len(rows)
    assert {r.status: r.n for r in again["counts"].collect()} == {"has_data": 4, "no_run_info": 1, "no_data": 2, "download_error": 1, "invalid_format": 1}


def test_keyword_search(spark, client):
    rows = {r.accession: r for r in H.keyword_search(spark, client, ["gut"], ["mouse", "man"]).collect()}
    assert set(rows) == {"PRJNA1", "PRJNA3", "PRJCA5"}
    assert (rows["PRJNA1"].title, rows["PRJNA1"].organism, rows["PRJCA5"].source, rows["PRJNA3"].query) == ("A & B", "mouse gut", "CNCB", '("gut") AND ("man")')


def test_nothing_found(spark, client, tmp_path):
    out = H.harvest_study(spark, client, spark.createDataFrame([("PRJNA3",), ("x",)], "id string"), str(tmp_path))
    assert out["table"] is None and {r.status for r in out["status"].collect()} == {"no_data", "invalid_format"}
