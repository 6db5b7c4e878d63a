"""Shared fixtures: one local session, the shipped sample domain as CSV files."""

from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"

# Fixed values (golden input): the three shipped raw sample tables, as text.
AFFILIATES_CSV = """id,code,origin,redeemed_at
1,DWEHSP,YouTube,2024-01-10 17:07:01+00:00
2,QGKTBC,Discord,2024-02-13 05:40:50+00:00
3,YRLUJA,X,2024-02-24 04:35:15+00:00
4,ZXCVBN,,2024-03-27 16:28:29+00:00
5,POIUYT,YouTube,2024-04-16 19:27:32+00:00
6,LKJHGF,Discord,2024-09-05 07:53:23+00:00
7,MNBVCX,,2024-10-13 00:24:33+00:00
8,ASDFGH,X,2024-10-14 23:45:05+00:00
9,HGFDSA,YouTube,
10,TREWQS,Discord,
"""

PLAYERS_CSV = """id,affiliate_id,country_code,is_kyc_approved,created_at,updated_at
1,1,DE,TRUE,2024-01-10 17:07:01+00:00,2024-02-08 09:05:26+00:00
2,,BR,TRUE,2024-02-09 19:19:27+00:00,2024-03-05 08:06:20+00:00
3,2,BR,TRUE,2024-02-13 05:40:50+00:00,2024-02-17 10:58:17+00:00
4,3,GB,TRUE,2024-02-24 04:35:15+00:00,2024-03-05 19:19:09+00:00
5,4,AU,FALSE,2024-03-27 16:28:29+00:00,2024-04-01 05:38:15+00:00
6,,FR,TRUE,2024-04-05 02:33:27+00:00,2024-04-06 13:16:25+00:00
7,5,CA,TRUE,2024-04-16 19:27:32+00:00,2024-04-18 08:29:18+00:00
8,6,BR,TRUE,2024-09-05 07:53:23+00:00,2024-10-01 19:17:16+00:00
9,7,AU,FALSE,2024-10-13 00:24:33+00:00,2024-10-24 07:28:43+00:00
10,8,CA,FALSE,2024-10-14 23:45:05+00:00,2024-11-04 11:19:33+00:00
10,8,CA,TRUE,2024-10-14 23:45:05+00:00,2024-11-06 12:31:09+00:00
"""

TRANSACTIONS_CSV = """id,timestamp,player_id,type,amount
1,2024-01-10 17:07:01+00:00,7,Withdraw,213.13
2,2024-02-09 19:19:27+00:00,4,Withdraw,182.64
3,2024-02-13 05:40:50+00:00,8,Withdraw,184.22
4,2024-02-24 04:35:15+00:00,5,Deposit,304.94
5,2024-03-27 16:28:29+00:00,7,Withdraw,525.23
6,2024-04-05 02:33:27+00:00,10,Deposit,432.51
7,2024-04-16 19:27:32+00:00,3,Withdraw,291.94
8,2024-09-05 07:53:23+00:00,7,Withdraw,612.24
9,2024-10-13 00:24:33+00:00,8,Withdraw,140.35
10,2024-10-14 23:45:05+00:00,5,Withdraw,292.85
"""


@pytest.fixture(scope="session")
def scratch():
    return tempfile.mkdtemp(prefix="strata-test-")


@pytest.fixture(scope="session")
def spark(scratch):
    from strata.session import get_session
    s = get_session("local[4]", app="strata-tests", shuffle_partitions=8,
                    spark__sql__warehouse__dir=f"{scratch}/warehouse")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(f"{scratch}/checkpoints")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sample_dir(scratch):
    """Folder with affiliates.csv, players.csv, transactions.csv (the shipped sample)."""
    d = os.path.join(scratch, "sample")
    os.makedirs(d, exist_ok=True)
    for name, text in [("affiliates", AFFILIATES_CSV), ("players", PLAYERS_CSV),
                       ("transactions", TRANSACTIONS_CSV)]:
        with open(os.path.join(d, f"{name}.csv"), "w") as f:
            f.write(text)
    return d


@pytest.fixture(scope="session")
def sample_raw(spark, sample_dir):
    """The sample tables read as raw all-string frames, with input order."""
    from strata.sources.io import read_raw_csv
    return {n: read_raw_csv(spark, f"{sample_dir}/{n}.csv", with_order=True)
            for n in ("affiliates", "players", "transactions")}
