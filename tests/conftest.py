"""Shared session, and exports written for the tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitals.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

Q = "HKQuantityTypeIdentifier"
PULSE, WALKED, BURNT, SCALE = Q + "HeartRate", Q + "StepCount", Q + "ActiveEnergyBurned", Q + "BodyMass"
NIGHT = "HKCategoryTypeIdentifierSleepAnalysis"
ZONE = "+0900"


def tag(name, children="", **attributes):
    """An XML element; attribute values are written as they are (escaped by the caller)."""
    head = "".join(f' {k}="{v}"' for k, v in attributes.items() if v is not None)
    return f"<{name}{head}>{children}</{name}>" if children else f"<{name}{head}/>"


def measured(kind, value, when, device="Band", until=None, unit="n", zone=ZONE, children=""):
    start = f"{when} {zone}" if zone else when
    end = f"{until} {zone}" if until else start
    return tag("Record", children, type=kind, sourceName=device, unit=unit, creationDate=start, startDate=start, endDate=end, value=value)


def slept(stage, start, end, device="Band"):
    return measured(NIGHT, f"HKCategoryValueSleepAnalysis{stage}", start, device, end, unit=None)


def session(activity, minutes, when, children="", device="Band", zone=ZONE):
    start = f"{when} {zone}" if zone else when
    return tag("Workout", children, workoutActivityType=f"HKWorkoutActivityType{activity}", duration=minutes, durationUnit="min",
               sourceName=device, startDate=start, endDate=start)


def document(*elements):
    return "\n".join(['<?xml version="1.0"?>', "<!DOCTYPE HealthData [ <!ELEMENT Record ANY> ]>", "<HealthData>", *elements, "</HealthData>", ""])


FAKE = measured(PULSE, "999", "2024-02-28 01:00:00")
RECORDS = [
    # one pulse, told twice with another spelling and another end; then two rows that differ in the unit only
    measured(PULSE, "58", "2024-02-28 07:15:00"),
    measured(PULSE, "58.0", "2024-02-28 07:15:00", until="2024-02-28 07:16:00"),
    measured(PULSE, "64", "2024-02-28 21:00:00"),
    measured(PULSE, "64", "2024-02-28 21:00:00", unit="per min"),
    # half past midnight: the day before in UTC; a leap day
    measured(PULSE, "49", "2024-02-29 00:30:00", children=tag("MetadataEntry", key="context", value="rest")),
    # spelled in another way, but read
    measured(PULSE, " 61 ", "2024-3-1  6:05:00", zone="+09:00"),
    # not read: the number, the time, both
    measured(PULSE, "n/a", "2024-02-29 09:00:00"),
    measured(PULSE, "71", "29.02.2024 10:00"),
    measured(PULSE, "?", "soon", zone=""),
    # two devices a day: the better one counts, not the sum
    measured(WALKED, "4_200", "2024-02-28 08:00:00"),
    measured(WALKED, "800", "2024-02-28 18:00:00"),
    measured(WALKED, "5100", "2024-02-28 08:00:00", "Pocket &amp; Co"),
    measured(WALKED, "0", "2024-02-29 08:00:00", "Pocket &amp; Co"),
    measured(WALKED, "2500", "2024-03-01 08:00:00"),
    measured(WALKED, "2500", "2024-03-01 08:00:00", "Pocket &amp; Co"),
    measured(BURNT, "120.4", "2024-02-28 12:00:00"),
    measured(BURNT, "310.5", "2024-02-29 12:00:00"),
    measured(SCALE, "70.1", "2024-02-28 06:00:00", "a &gt; b"),
    measured(SCALE, "70", "2024-02-29 06:00:00"),
    measured(SCALE, "70.3", "2024-02-29 06:10:00"),
    tag("Correlation", measured(SCALE, "69.9", "2024-03-01 06:00:00"), type="pair"),
    measured(Q + "EnvironmentalAudioExposure", "55", "2024-02-28 12:00:00"),
    # nights by the day of the end; odd seconds; a negative length; a night in bed without sleep; no end
    slept("AsleepCore", "2024-02-28 23:10:30", "2024-02-29 00:40:10"),
    slept("AsleepREM", "2024-02-29 00:40:10", "2024-02-29 01:10:50"),
    slept("Awake", "2024-02-29 01:10:50", "2024-02-29 01:20:00"),
    slept("AsleepDeep", "2024-02-29 02:00:00", "2024-02-29 01:58:00"),
    slept("AsleepCore", "2024-02-28 23:00:00", "2024-02-28 23:30:00", "Ring"),
    slept("InBed", "2024-02-29 23:00:00", "2024-03-01 06:00:00"),
    slept("AsleepCore", "2024-02-29 22:00:00", "later"),
    # not real: inside a comment and a CDATA section
    f"<!-- {FAKE} <Workout> -->",
    f"<Note><![CDATA[ {FAKE} <Workout a='b'> <!-- ]]></Note>",
]
SESSIONS = [
    session(
        "Swimming", "41.25", "2024-02-28 19:00:00",
        tag("MetadataEntry", key="HKIndoorWorkout", value="0")
        + tag("MetadataEntry", key="HKIndoorWorkout", value="1")
        + tag("WorkoutEvent", tag("Lap", measured(PULSE, "151", "2024-02-28 19:20:00") + tag("MetadataEntry", key="HKIndoorWorkout", value="0")))
        + measured(PULSE, "150", "2024-02-28 19:10:00")
        + tag("WorkoutStatistics", type=BURNT, sum="200.25", unit="kcal")
        + tag("WorkoutStatistics", type=BURNT, sum="49.75", unit="kcal")
        + tag("WorkoutStatistics", type=Q + "DistanceSwimming", sum="1.5", unit="km")
        + tag("WorkoutStatistics", type=Q + "DistanceWalkingRunning", sum=".25", unit="km")
        + f"<!-- {tag('WorkoutStatistics', type=BURNT, sum='1000')} </Workout> -->",
    ),
    # a line break after the tag's name
    session("Yoga", "20", "2024-02-29 07:00:00").replace("<Workout ", "<Workout\n\t"),
    # the prefix alone, a sum that is no number, a sum that is missing
    session("", "5.05", "2024-03-01 07:00:00", tag("WorkoutStatistics", type=BURNT, sum="abc") + tag("WorkoutStatistics", type=Q + "DistanceCycling"), "Ring"),
    session("Rowing", "9", "whenever", zone=""),
]
EXPORT = document(*RECORDS, *SESSIONS)


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


@pytest.fixture(scope="session")
def spark():
    yield local_session(4, shuffle_partitions=4, app="vitals-tests")


@pytest.fixture(scope="session")
def scratch(tmp_path_factory):
    return str(tmp_path_factory.mktemp("vitals"))


@pytest.fixture(scope="session")
def export_path(scratch):
    return put(f"{scratch}/input/export.xml", EXPORT)


@pytest.fixture(scope="session")
def export_run(spark, export_path, scratch):
    from vitals.plans.jobs import run_export

    root = f"{scratch}/data"
    return {"root": root, "report": run_export(spark, export_path, root, run_at="2024-03-02T00:00:00+00:00")}
