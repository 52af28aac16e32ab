"""A seeded pack of the eight raw files with defects whose number is known."""

from __future__ import annotations

import csv
import datetime as dt
import random
from pathlib import Path

HEADERS = {
    "account": ["account_id", "district_id", "frequency", "date"],
    "client": ["client_id", "birth_number", "district_id"],
    "disp": ["disp_id", "client_id", "account_id", "type"],
    "card": ["card_id", "disp_id", "type", "issued"],
    "loan": ["loan_id", "account_id", "date", "amount", "duration", "payments", "status"],
    "order": ["order_id", "account_id", "bank_to", "account_to", "amount", "k_symbol"],
    "district": [f"A{i}" for i in range(1, 17)],
    # Not the declared order: columns are bound by name.
    "trans": ["trans_id", "account_id", "date", "type", "operation", "k_symbol", "amount", "balance", "bank", "account"],
}


def yymmdd(day: dt.date) -> int:
    return int(day.strftime("%y%m%d"))


def make_pack(seed: int = 7, accounts: int = 60) -> tuple[dict[str, list[list]], dict[str, int]]:
    """Rows by table, and the failing rows by check."""
    rng = random.Random(seed)
    rows: dict[str, list[list]] = {name: [] for name in HEADERS}
    for d in range(1, 7):
        figures = [rng.randint(10, 900) for _ in range(6)]
        rows["district"].append(
            [d, f"Town {d}", f"Region {d % 2}", *figures, 55.5, 8000 + 100 * d, "?" if d == 4 else 1.5, 2.25 + d / 4, 120,
             " ? " if d == 5 else 800, 900 + d]
        )
    trans_id = 1
    for a in range(1, accounts + 1):
        opened = dt.date(1993, 1, 1) + dt.timedelta(days=rng.randint(0, 1500))
        frequency = ["POPLATEK MESICNE", "POPLATEK TYDNE", "POPLATEK PO OBRATU", "OTHER"][a % 4]
        rows["account"].append([a, a % 6 + 1, frequency, yymmdd(opened)])
        month = rng.randint(1, 12)
        born = rng.randint(3, 80) * 10000 + (month + (50 if a % 2 else 0)) * 100 + rng.randint(1, 28)
        rows["client"].append([a, born, a % 6 + 1])
        rows["disp"].append([a, a, a, "OWNER"])
        if a % 3 == 0:
            rows["card"].append([a, a, ["gold", "classic", "junior"][a % 9 // 3], f"{yymmdd(opened)} 00:00:00"])
        if a % 2 == 0:
            duration = rng.choice([12, 24, 36])
            amount = duration * rng.randint(500, 3000)
            rows["loan"].append([a, a, yymmdd(dt.date(1998, 6, 1)), amount, duration, f"{amount / duration:.2f}", "ABCD"[a // 2 % 4]])
        rows["order"].append([a, a, "YZ", 1000 + a, f"{rng.randint(100, 9000)}.50", ["SIPO", "UVER", " ", "", "LEASING"][a % 5]])
        cents, day = 0, opened
        for n in range(rng.randint(5, 40)):
            day = min(day + dt.timedelta(days=rng.randint(0, 60)), dt.date(1998, 12, 31))
            credit = n == 0 or rng.random() < 0.6
            amount = rng.randint(100, 200000) if credit else rng.randint(100, max(101, cents // 2))
            cents += amount if credit else -amount
            kind, operation = ("PRIJEM", "VKLAD") if credit else ("VYDAJ", "VYBER")
            rows["trans"].append(
                [trans_id, a, yymmdd(day), kind, operation, "", f"{amount / 100:.2f}", f"{cents / 100:.2f}", "", ""]
            )
            trans_id += 1

    expected = {}

    def last_of(account: int) -> list:
        return [row for row in rows["trans"] if row[1] == account][-1]

    # Legacy code and the two spellings of no purpose.
    debits = [row for row in rows["trans"] if row[3] == "VYDAJ"][:9]
    for row in debits:
        row[3] = "VYBER"
    expected["TXN_LEGACY_TYPE_CODE"] = len(debits)
    for row in rows["trans"][10:27]:
        row[5] = " "
    expected["TXN_SYMBOL_INCONSISTENT_ENCODING"] = 17
    # Operation missing: two as interest, three without a reason.
    for row, symbol in zip(rows["trans"][40:45], ["UROK", " UROK ", "SIPO", "", "SIPO"], strict=True):
        row[4], row[5] = "", symbol
    expected["TXN_NULL_OPERATION_UNEXPLAINED"] = 3
    # Transfers: bank missing, account missing, complete.
    for row, bank, account in zip(rows["trans"][60:63], ["", "AB", "AB"], ["12", "", "12"], strict=True):
        row[4], row[8], row[9] = "PREVOD NA UCET", bank, account
    expected["TRANSFER_MISSING_COUNTERPARTY"] = 2
    # Balances of two accounts off by more than the tolerance, one by less.
    for account, off in ((5, 1.01), (6, 250.0), (7, 0.99)):
        row = last_of(account)
        row[7] = f"{float(row[7]) + off:.2f}"
    expected["BALANCE_RECON_ACCOUNT"] = 2
    # Repeats under other ids: one row twice more, one once more; a NULL and a blank symbol differ.
    first, second = rows["trans"][100], rows["trans"][101]
    for n, row in enumerate([first, first, second]):
        rows["trans"].append([900000 + n, *row[1:]])
    blank = list(first)
    blank[0], blank[5] = 900010, " "
    blank_balance = blank[7]
    rows["trans"].append(blank)
    # The blank twin is no duplicate; take its effect out again the next day.
    undo = list(blank)
    undo[0], undo[3], undo[7] = 900011, "VYDAJ" if blank[3] == "PRIJEM" else "PRIJEM", blank_balance
    rows["trans"].append(undo)
    expected["TXN_SYMBOL_INCONSISTENT_ENCODING"] += 2
    expected["TXN_DUPLICATE_POSTING"] = 3
    # Nil interest.
    nil = list(last_of(9))
    nil[0], nil[4], nil[5], nil[6] = 900020, "", "UROK", "0.00"
    rows["trans"].append(nil)
    expected["TXN_ZERO_AMOUNT"] = 1
    expected["NEGATIVE_BALANCE_TXNS"] = 0
    expected["DISTRICT_MISSING_VALUE"] = 2

    # Orphans.
    rows["disp"].append([5001, 77777, 1, "DISPONENT"])
    rows["disp"].append([5002, 1, 88888, "DISPONENT"])
    rows["loan"].append([5003, 88889, 980101, 1200, 12, "100.00", "A"])
    rows["trans"].append([5000004, 88890, 980101, "PRIJEM", "VKLAD", "", "10.00", "10.00", "", ""])
    rows["card"].append([5005, 99999, "gold", "980101 00:00:00"])
    rows["client"].append([5006, 700101, ""])
    for name in ("FK_DISP_CLIENT", "FK_DISP_ACCOUNT", "FK_LOAN_ACCOUNT", "FK_TRANS_ACCOUNT", "FK_CARD_DISP", "FK_CLIENT_DISTRICT"):
        expected[name] = 1
    # Owners: account 10 has none, account 11 has two.
    rows["disp"] = [row for row in rows["disp"] if row[0] != 10]
    rows["disp"].append([5010, 12, 11, "OWNER"])
    expected["ACCOUNT_WITHOUT_OWNER"] = 1
    expected["ACCOUNT_MULTIPLE_OWNERS"] = 1
    expected["RECON_ACCOUNT_MONTH_SPINE"] = 1
    expected["FK_CARD_DISP"] += sum(row[1] == 10 for row in rows["card"])
    # Payments 2 % and 0.5 % off.
    for row, factor in ((rows["loan"][0], 1.02), (rows["loan"][1], 1.005)):
        row[5] = f"{row[3] / row[4] * factor:.2f}"
    expected["LOAN_PAYMENT_ARITHMETIC"] = 1
    # Dates before opening.
    opened = {row[0]: row[3] for row in rows["account"]}
    late = [a for a in range(20, accounts) if opened[a] > 940101][0]
    rows["loan"].append([6001, late, 930101, 1200, 12, "100.00", "C"])
    rows["card"].append([6002, late, "junior", "930101 00:00:00"])
    early = [6003, late, 930102, "PRIJEM", "VKLAD", "", "0.01", "0.01", "", ""]
    rows["trans"].append(early)
    for name in ("LOAN_BEFORE_ACCOUNT_OPEN", "CARD_BEFORE_ACCOUNT_OPEN", "TXN_BEFORE_ACCOUNT_OPEN"):
        expected[name] = 1
    rows["client"].append([6004, 700231, 1])
    expected["CLIENT_INVALID_BIRTH_DATE"] = 1
    expected["RECON_RAW_VS_STG_TRANS"] = 0
    return rows, expected


def write_pack(folder: Path, rows: dict[str, list[list]]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    for name, header in HEADERS.items():
        with open(folder / f"{name}.asc", "w", newline="") as out:
            out.write(";".join(f'"{column}"' for column in header) + "\n")
            writer = csv.writer(out, delimiter=";", quoting=csv.QUOTE_NONNUMERIC)
            writer.writerows(rows[name])
