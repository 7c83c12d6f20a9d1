"""Landed feed files as the sources deliver them: one JSON array or object per file."""

import json

from tidemark.schemas import MEASURES


def put(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps(content), encoding="utf-8")


def place(loc, name="Lake", country="GE", region="GE-1"):
    return {
        "locId": loc, "name": name, "latitude": 1.5, "longitude": 2.5, "countryCode": country,
        "countryName": "Georgia", "subnational1Name": "Tbilisi", "subnational1Code": region,
        "isHotspot": True, "locName": name, "lat": 1.5, "lng": 2.5, "hierarchicalName": f"{name}, Tbilisi",
        "locID": loc,
    }


def checklist(sub, loc, day, clock, species=2, who="Ana", **place_args):
    record = {
        "locId": loc, "subId": sub, "userDisplayName": who, "numSpecies": species, "obsDt": day,
        "subID": sub, "loc": place(loc, **place_args),
    }
    if clock is not None:
        record["obsTime"] = clock
    return record


def observation(code, when, sub, obs, count):
    return {
        "speciesCode": code, "obsDt": when, "subId": sub, "projId": "P", "obsId": obs, "howManyStr": count,
        "present": True, "hideFlags": [], "subnational1Code": "GE-1", "howManyAtleast": 1, "howManyAtmost": 1,
    }


def land_dictionaries(root, version="first"):
    put(root / "hotspots", "hotspots.json", [
        {"locId": "L1", "locName": "Lake", "countryCode": "GE", "subnational1Code": "GE-1", "lat": 1.5, "lng": 2.5,
         "latestObsDt": "2023-08-01 07:05", "numSpeciesAllTime": 11},
        {"locId": "L9", "locName": "Marsh", "countryCode": "ZZ", "subnational1Code": "ZZ-1", "lat": 1.5, "lng": 2.5,
         "latestObsDt": "2023-08-01 07:05"},
    ])
    put(root / "countries", "countries.json", [{"code": "GE", "name": "Georgia"}])
    put(root / "subregions", "subregions.json", [{"code": "GE-1", "name": "Tbilisi"}])
    species = [("robin", "O1", "f1"), ("heron", "O2", "f2")]
    put(root / "taxonomy", "taxonomy.json", [
        {"speciesCode": c, "sciName": f"{c} sci", "comName": f"{c} com", "category": "species", "order": o,
         "familyCode": f, "familySciName": f"{f} sci"}
        for c, o, f in (species if version == "first" else species[:1])
    ])


def land_first(root):
    put(root / "checklists", "2023-08-01.json", [
        checklist("S1", "L1", "1 Aug 2023", "07:05"), checklist("S2", "L2", "1 Aug 2023", None, name="Hill"),
        checklist("S1", "L1", "1 Aug 2023", "07:05"),
    ])
    put(root / "checklists", "2023-07-01.json", [checklist("S0", "L1", "1 Jul 2023", "07:05")])
    put(root / "observations", "S1.json", {"obs": [
        observation("robin", "2023-08-01 07:05", "S1", "O1", "3"), observation("heron", "2023-08-01 07:05", "S1", "O2", "X"),
    ]})
    put(root / "observations", "S2.json", {"obs": [
        observation("robin", "2023-08-01 00:00", "S2", "O3", "1"), observation("robin", "2023-08-01 00:00", "S2", "O4", "5"),
    ]})
    put(root / "observations", "S0.json", {"obs": [observation("robin", "2023-07-01 07:05", "S0", "O0", "9")]})


def land_second(root):
    put(root / "checklists", "2023-09-02.json", [
        checklist("S3", "L2", "2 Sep 2023", "09:30", name="Hill top"),
        checklist("S1", "L1", "3 Sep 2023", "06:00", who="Ana B."),
    ])
    put(root / "observations", "S3.json", {"obs": [observation("owl", "2023-09-02 09:30", "S3", "O5", "2")]})
    put(root / "observations", "S1.json", {"obs": [
        observation("robin", "2023-09-03 06:00", "S1", "O1", "4"), observation("heron", "2023-08-01 07:05", "S1", "O2", "X"),
    ]})


def land_weather(root, answers):
    for loc, day, tavg in answers:
        record = {"date": day, **dict.fromkeys(MEASURES, 1.0), "tavg": tavg}
        put(root / "weather", f"{loc}-{day}.json", {
            "loc_id": loc, "obsdt": day, "status": 200, "data": [record] if tavg is not None else []})
