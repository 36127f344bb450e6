"""Random export files against a row-by-row reading of the rules."""

import random
from datetime import datetime

import pytest

from fleetmatch.functions.text import WHITESPACE
from fleetmatch.operators.inventory import parse_inventory
from fleetmatch.schemas import ALIASES_A, ALIASES_B, endpoint_inventory, remote_inventory
from fleetmatch.sources.delimited import read_export

RUN_TS = datetime(2024, 1, 31)


def strip(text):
    return text.strip(WHITESPACE)


def key_of(text):
    name = strip(text).upper()
    for suffix in (".CORPORATE.GHA.COM", ".GHA.COM", ".CORP", ".LOCAL"):
        name = name.removesuffix(suffix)
    return name[:15]


def platform_of(text):
    name = text.lower()
    if "windows" in name:
        return "Windows Server" if "server" in name else "Windows"
    if any(word in name for word in ("macos", "mac os", "darwin")):
        return "macOS"
    if any(word in name for word in ("linux", "ubuntu", "centos", "rhel", "debian", "suse")):
        return "Linux"
    return name[:1].upper() + name[1:] if text else "UNKNOWN"


def status_of(text):
    name = text.lower()
    if name in ("1", "true", "yes", "online", "active"):
        return "Online"
    if name in ("0", "false", "no", "offline", "inactive"):
        return "Offline"
    return name[:1].upper() + name[1:] if text else "Unknown"


def read_rows(text, aliases):
    lines = [line for line in text.split("\n") if strip(line)]
    head = lines[0]
    tabs, semicolons, commas = head.count("\t"), head.count(";"), head.count(",")
    delimiter = "\t" if tabs > commas and tabs > semicolons else ";" if semicolons > commas else ","
    names = [strip(name).lower() for name in head.split(delimiter)]
    places = {field: next((names.index(n) for n in options if n in names), -1) for field, options in aliases.items()}
    first = {}
    for line in lines[1:]:
        cells = [strip(cell) for cell in line.split(delimiter)]
        if len(cells) < 2:
            continue

        def cell(field):
            place = places[field]
            return cells[place] if 0 <= place < len(cells) else None

        key = key_of(cell("hostname") or "")
        if key:
            first.setdefault(key, [{field: cell(field) for field in aliases}, 0])[1] += 1
    return first, places


def expected_a(text):
    rows, places = read_rows(text, ALIASES_A)
    return {key: (raw["description"], platform_of(raw["platform"] or ""), raw["ip_address"] or None,
                  raw["last_seen"] if places["last_seen"] >= 0 else "2024-01-31T00:00:00.000Z", n)
            for key, (raw, n) in rows.items()}


def expected_b(text):
    rows, _ = read_rows(text, ALIASES_B)
    return {key: (raw["os_version"] or None, status_of(raw["status"] or ""), raw["agent_version"] or None, n)
            for key, (raw, n) in rows.items()}


def random_file(seed):
    chosen = random.Random(seed)
    delimiter = chosen.choice([",", ";", "\t"])
    names = ["Host Name", " ID ", "os", "IP", "Name", "last seen", "Status", "Version", "x", "os version"]
    header = chosen.sample(names, 8)
    if not {"Host Name", " ID "} & set(header):
        header[0] = "Host Name"
    end = chosen.choice(["\n", "\r\n"])
    words = ["wks-", "srv", "1", "2", "7", ".corp", ".local", ".GHA.com", ".corporate.gha.com", " ", " ", '"', "'",
             "\\", "\r", "Windows", "server", "linux", "MAC OS", "yes", "0", "é", "　", "2024-01-05", "#", ",", ";"]

    def word():
        return "".join(chosen.choice(words) for _ in range(chosen.randrange(4)))

    lines = ["﻿" + delimiter.join(header)] if chosen.random() < 0.5 else ["", " \t", delimiter.join(header)]
    for _ in range(600):
        shape = chosen.random()
        if shape < 0.05:
            lines.append(chosen.choice(["", "   ", "\t", " "]))
        elif shape < 0.1:
            lines.append(word())
        else:
            host = chosen.choice(["wks-", "WKS-", " srv-"]) + str(chosen.randrange(80)) + chosen.choice(
                ["", ".corp", ".local", ".gha.com ", ".local.corp"])
            cells = [host if name in ("Host Name", " ID ") and chosen.random() < 0.7 else word() for name in header]
            lines.append(delimiter.join(cells[:chosen.randrange(1, len(cells) + 1)] + [word()] * (shape > 0.95)))
    return end.join(lines) + chosen.choice(["", end])


@pytest.mark.parametrize("seed", range(6))
def test_random_file(spark, tmp_path, seed):
    text = random_file(seed)
    path = tmp_path / "export.txt"
    path.write_bytes(text.encode("utf-8"))
    visible = text.removeprefix("﻿")

    rows = parse_inventory(read_export(spark, str(path)), remote_inventory(), RUN_TS).collect()
    assert {r.hostname: (r.description, r.platform, r.ip_address, r.last_seen, r.source_rows)
            for r in rows} == expected_a(visible)
    assert len(rows) > 20

    rows = parse_inventory(read_export(spark, str(path)), endpoint_inventory(), RUN_TS).collect()
    assert {r.hostname: (r.os_version, r.status, r.agent_version, r.source_rows) for r in rows} == expected_b(visible)
