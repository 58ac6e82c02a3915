"""Invented fixture rows (FIXTURES.md shapes and edge rows)."""

from __future__ import annotations

import os


def raw_fact_rows() -> list[tuple]:
    """Raw arrival rows in RAW_FACT_SCHEMA order.

    cicid, i94cit, i94res, i94port, arrdate, i94mode, i94addr, depdate, i94bir,
    i94visa, dtadfile, visapost, biryear, dtaddto, gender, airline, admnum, fltno
    """
    base = [
        # stay limit differs from the file date (B1)
        (1.0, 101.0, 101.0, "NYC", 20545.0, 1.0, "NY", 20550.0, 30.0, 2.0, "20160401", "LND", 1986.0, "10012016", "M", "BA", 5680949530.0, "00117"),
        # null departure, D/S stay, address GU (not a state, B20)
        (2.0, 102.0, 103.0, "MIA", 20546.0, 1.0, "GU", None, 41.0, 1.0, "20160402", None, 1975.0, "D/S", "F", "AA", 123.0, "00201"),
        # empty and null stay text, address 99, birth code without a list entry
        (3.0, 999.0, 101.0, "LAX", 20547.0, 2.0, "99", 20560.0, 25.0, 3.0, "20160403", "SEO", 1991.0, "", None, "KE", 456.0, "00017"),
        (4.0, 101.0, 102.0, "SFR", 20576.0, 1.0, "CA", 20590.0, 52.0, 2.0, "20160502", "MEX", 1964.0, None, "M", "AM", 789.0, "XBLNG"),
    ]
    return base


def raw_fact_edge_rows() -> list[tuple]:
    """Edge rows that must stop a load: an identical pair, one id twice, a null id."""
    dup = (5.0, 101.0, 101.0, "NYC", 20548.0, 1.0, "NY", 20555.0, 33.0, 2.0, "20160404", "LND", 1983.0, "07042016", "F", "VS", 1.0, "00003")
    other = (5.0, 102.0, 101.0, "BOS", 20548.0, 1.0, "MA", 20555.0, 33.0, 2.0, "20160404", "LND", 1983.0, "07042016", "F", "VS", 1.0, "00004")
    null_id = (None, 101.0, 101.0, "NYC", 20548.0, 1.0, "NY", None, 20.0, 2.0, "20160404", None, 1996.0, "D/S", "M", "VS", 2.0, "00005")
    return [dup, dup, other, null_id]


LABEL_TEXT = (
    "libname library 'Your file location' ;\r\n"
    "proc format library=library ;\r\n"
    "\r\n"
    "/* CODES - there are missing values as well as not reported */\r\n"
    "  value i94cntyl\r\n"
    "   101 =  'ALPHALAND'\r\n"
    "   102 =  'BETA, REPUBLIC OF'   \r\n"
    "   103 =  'GAMMA'\r\n"
    "   0 =  'INVALID: ZERO'\r\n"
    "   54 =  'No Country Code (54)'\r\n"
    "   103 =  'GAMMA ISLANDS'\r\n"
    "   104 =  'ONE' = 'TWO'\r\n"
    "   105 =  'DELTA' ;\r\n"
    "\r\n"
    "/* PORTS */\r\n"
    "  value $i94prtl\r\n"
    "   'AAA'\t=\t'ALPHA PORT, AK        '\r\n"
    "   'INT'\t=\t'INT''L FALLS, MN      '\r\n"
    "   'BBB' \t=\t'No PORT Code (BBB)'\r\n"
    ";\r\n"
    "\r\n"
    "value i94model\r\n"
    "\t1 = 'Air'\r\n"
    "\t9 = 'Not reported' ;\r\n"
    "\t\r\n"
)

STATES_CSV = '"State","Abbreviation"\n"New York","NY"\n"California","CA"\n"Massachusetts","MA"\n"New York","NY"\n'

RATES_CSV = (
    "Year,Month,State,County,Rate\n"
    "2016,April,New York,Kings County,5.0\n"
    "2016,April,New York,Kings County,5.0\n"       # exact duplicate: must not weigh
    "2016,April,New York,Queens County,4.0\n"
    "2016,April,New York,Bronx County,4.0\n"       # same rate in two counties: both count
    "2016,April,New York,Erie County,bad\n"        # bad rate: skipped by the average
    "2016,April,New York,Nassau County,\n"         # null rate
    "2016,May,California,Kern County,7.5\n"
    "2016,Mai,California,Kern County,7.5\n"        # misspelled month -> null month
)

# The same sheet without the row whose key cannot be typed.
RATES_CSV_CLEAN = "".join(line for line in RATES_CSV.splitlines(True) if ",Mai," not in line)


def write_text(folder: str, name: str, text: str, newline: str = "") -> str:
    path = os.path.join(folder, name)
    with open(path, "w", newline=newline) as fh:
        fh.write(text)
    return path
