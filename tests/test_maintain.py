"""A lake kept up to date by changes: every table equals a full computation, and untouched days keep their folders."""

import contextlib
import shutil

import pytest

from assaylake import EngineConfig
from assaylake.plans.build import adopt_stored
from assaylake.plans.maintain import STAGED, STORED_MARTS, Lake, Report
from assaylake.plans.nightly import build
from assaylake.sinks.raw import load_run
from assaylake.workspace import Workspace
from tests.test_checks import stored_vocabulary
from tests.test_marts import observation, patient, resource
from tests.test_storage import DAY, land

AT = "2024-0{}-01T00:00:00Z".format
SECOND, FOURTH = "2024-02-01", "2024-04-01"


def ref(kind, key):
    return {"reference": f"{kind}/{key}"}


def encounter(key, subject, month=1, start="2024-01-05T08:00:00Z", **members):
    return resource("Encounter", key, AT(month), subject=ref("Patient", subject), period={"start": start}, **{"class": {"code": "IMP"}}, **members)


def specimen(key, subject, month=1):
    return resource("Specimen", key, AT(month), subject=ref("Patient", subject), collection={"collectedDateTime": "2024-01-06T08:00:00Z"})


def report(key, *children, month=1, subject="p", **members):
    return resource("DiagnosticReport", key, AT(month), subject=ref("Patient", subject), effectiveDateTime="2024-01-07T08:00:00Z", result=[ref("Observation", c) for c in children], **members)


def measured(key, month=1, **members):
    return observation(key, updated=AT(month), **members)


class Site:
    """A landing folder and a lake; every night is compared with what a full computation gives."""

    def __init__(self, spark, tmp_path):
        self.spark, self.tmp_path, self.root = spark, tmp_path, str(tmp_path / "lake")
        self.config = EngineConfig(rows_per_bucket=4)

    def workspace(self):
        return Workspace.at(self.spark, self.root, self.config)

    def lake(self):
        return Lake(self.workspace(), f"{self.root}/staging", f"{self.root}/cdm")

    def night(self, day, days="loaded", **documents):
        for kind, found in documents.items():
            landing = land(self.tmp_path, f"{kind}-0000.ndjson", found, day)
        load_run(self.spark, landing, day, f"{self.root}/raw")
        return build(self.workspace(), self.root, days=[day] if days == "loaded" else days)

    def compare(self, names=(*STAGED, *STORED_MARTS)):
        stored, whole = self.workspace(), self.workspace()
        adopt_stored(stored, f"{self.root}/staging", f"{self.root}/cdm")
        for name in names:
            want = whole.model(name)
            got = stored.model(name).select(*want.columns)
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())), name

    def folders(self, name):
        return {(e.generation, e.part) for e in self.lake().mart(name).table.current().entries}


@contextlib.contextmanager
def settings(spark, **values):
    """Plans over a few rows cost more to compile than to interpret."""
    names = {k.replace("_", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def first_night(spark, tmp_path_factory):
    quick = {"spark_sql_codegen_wholeStage": "false", "spark_sql_codegen_factoryMode": "NO_CODEGEN", "spark_sql_shuffle_partitions": "1"}
    with settings(spark, **quick):
        yield built(Site(spark, tmp_path_factory.mktemp("site")))


@pytest.fixture
def site(first_night, tmp_path):
    """The lake after its first night, a copy for each test."""
    shutil.copytree(first_night.tmp_path, tmp_path, dirs_exist_ok=True)
    return Site(first_night.spark, tmp_path)


def built(site):
    stored_vocabulary(site.spark, site.root)
    others = [measured(f"x{i}", effectiveDateTime=f"2023-05-{i + 10}T10:00:00Z", encounter=ref("Encounter", "e1")) for i in range(9)]
    first = site.night(
        DAY,
        Patient=[patient("p", AT(1), birthDate="1980-01-01", address=[{"city": "A"}]), patient("q", AT(1), address=[{"city": "A"}])],
        Encounter=[encounter("e1", "p"), encounter("e2", "r")],
        Specimen=[specimen("s1", "p"), specimen("s2", "r")],
        DiagnosticReport=[report("r1", "a", encounter=ref("Encounter", "e1")), report("r2", "b", subject="r")],
        Observation=[
            measured("a", encounter=ref("Encounter", "e1"), specimen=ref("Specimen", "s1"), valueString="1"),
            measured("b", encounter=ref("Encounter", "e3"), effectiveDateTime="2024-01-08T10:00:00Z"),
            measured("c", subject="Patient/q", category="vital-signs"),
            measured("d", subject="Patient/r", specimen=ref("Specimen", "s2"), effectiveDateTime=None),
            *others,
        ],
    )
    assert first is None  # nothing was stored before, so everything was built
    return site


def test_late_patients_and_encounters_reach_old_facts(site):
    before = site.folders("omop_measurement")
    night = site.night(
        SECOND,
        Patient=[patient("r", AT(2)), patient("p", AT(2), birthDate="1981-01-01", address=[{"city": "B"}])],
        Encounter=[encounter("e3", "p", 2)],
        DiagnosticReport=[report("r3", "c", "b", month=2)],
    )
    assert night.kinds["omop_person"] == {"inserted": 1, "changed": 1}
    assert night.kinds["omop_location"] == {"inserted": 1}
    assert night.kinds["omop_visit_occurrence"] == {"inserted": 2}  # e3, and e2 with its patient
    assert night.kinds["omop_specimen"] == {"inserted": 1}
    # b has a visit and another report, d a person; a birth date and an address touch no measurement.
    assert night.kinds["omop_measurement"] == {"inserted": 1, "changed": 1}
    assert night.kinds["omop_fact_relationship"] == {"inserted": 2}
    after = site.folders("omop_measurement")
    assert {part for _, part in after - before} == {"measurement_date=2024-01-08", "measurement_date=__HIVE_DEFAULT_PARTITION__"}
    assert night.rewritten["omop_measurement"] == 1 and len(before & after) == len(before) - 1
    site.compare()
    # The same day once more changes nothing, and nothing is written.
    again = Report()
    for name in ("stg_patient", "observation_versions"):
        site.lake().refresh_staged(name, [SECOND], again).drop()
    assert not any(again.kinds.values()) and not any(again.written.values())


def test_reloads_take_back_what_they_no_longer_hold(site):
    """The second day is loaded twice; only the staged relations see the first load's outcome stored."""
    land(site.tmp_path, "Encounter-0000.ndjson", [encounter("e3", "p", 2), encounter("e1", "p", 2, "2024-01-09T08:00:00Z")], SECOND)
    newer = [measured("a", 2, valueString="2", effectiveDateTime="2024-01-12T10:00:00Z"), measured("c", 2, subject="Patient/q"), measured("n", 2)]
    load_run(site.spark, land(site.tmp_path, "Observation-0000.ndjson", newer, SECOND), SECOND, f"{site.root}/raw")
    lake, first = site.lake(), Report()
    for name in ("stg_encounter", "observation_versions"):
        lake.refresh_staged(name, [SECOND], first).drop()
    assert first.kinds == {"stg_encounter": {"inserted": 1, "changed": 1}, "observation_versions": {"inserted": 1, "changed": 2}}
    site.compare(["stg_encounter", "observation_versions"])
    land(site.tmp_path, "Encounter-0000.ndjson", [encounter("e4", "q", 2)], SECOND)
    load_run(site.spark, land(site.tmp_path, "Observation-0000.ndjson", [measured("n", 2, valueString="n")], SECOND), SECOND, f"{site.root}/raw")
    second = Report()
    for name in ("stg_encounter", "observation_versions"):
        lake.refresh_staged(name, [SECOND], second).drop()
    assert second.recovered == {"stg_encounter": 2, "observation_versions": 2}
    assert second.kinds["stg_encounter"] == {"inserted": 1, "changed": 1, "withdrawn": 1}
    assert second.kinds["observation_versions"] == {"changed": 3}
    site.compare(["stg_encounter", "observation_versions"])


def test_persons_and_specimens_that_go_take_their_facts_along(site):
    night = site.night(DAY, Patient=[patient("q", AT(1), address=[{"city": "C"}])], Specimen=[specimen("s2", "r")])
    assert night.kinds["omop_person"]["withdrawn"] == 1
    assert night.kinds["omop_measurement"] == {"withdrawn": 11} and night.kinds["omop_fact_relationship"] == {"withdrawn": 2}
    assert night.kinds["omop_location"] == {"inserted": 1, "withdrawn": 1}
    assert site.folders("omop_measurement") == set()
    site.compare(["omop_location", "omop_person", "omop_measurement", "omop_fact_relationship", "omop_specimen"])


def test_without_days_all_raw_rows_are_compared(site):
    night = site.night(FOURTH, days=None, Patient=[patient("r", AT(4))], Specimen=[specimen("s1", "nobody", 4)])
    assert night.kinds["stg_patient"] == {"inserted": 1} and night.kinds["stg_encounter"] == {}
    assert night.kinds["omop_specimen"] == {"withdrawn": 1, "inserted": 1}
    assert night.kinds["omop_measurement"] == {"changed": 1, "inserted": 1}
    site.compare(["stg_patient", "omop_visit_occurrence", "omop_specimen", "omop_measurement", "omop_fact_relationship"])
