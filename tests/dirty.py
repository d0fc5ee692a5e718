"""Small handwritten extracts, policies and questions with known outcomes.

Each record is there for one rule or one step of the refinement; its name or number says which.
"""

from __future__ import annotations

import json
import os

CUSTOMERS = """customer_id,full_name,email,region,segment,updated_at
C0410,Ivy Lund,ivy@post.test,EMEA,enterprise,2025-05-04 08:00:00
 c0411 ,jo PARR,jo@post.test,na,SMB,2025-05-04 08:00:00
C0412,OLD ROW, OLD@POST.TEST ,LATAM,midmarket,2025-05-01 08:00:00
C0412,New Row,new@post.test,APAC,midmarket,2025-05-06 08:00:00
K0413,Other Prefix,k@post.test,NA,smb,2025-05-04 08:00:00
C0414,Unknown Region,u@post.test,POLE,smb,2025-05-04 08:00:00
C0415,Unreadable Time,r@post.test,NA,smb,soon
C0416,No Sign,post.test,NA,smb,2025-05-04 08:00:00
C0417,Same Time A,a@post.test,NA,smb,2025-05-04 08:00:00
C0417,Same Time B,b@post.test,EMEA,smb,2025-05-04 08:00:00
"""


def _bill(number, ref, amount, currency="USD", status="paid", issued="2025-06-10T12:00:00Z"):
    return {"invoice_id": number, "customer_ref": ref, "amount": amount, "currency": currency, "status": status,
            "issued_at": issued}


INVOICES = [
    _bill("B-EUR", "410", "20.10", "EUR"),
    _bill("B-TWICE", " 0410", "300.50"),
    _bill("B-TWICE", " 0410", "300.50"),
    _bill("B-HALF-CENT", "0411", "0.375", "GBP"),
    _bill("B-OPEN", "412", "64.00", status="Open", issued="2025-07-01T12:00:00Z"),
    _bill("B-VOID", "412", "81.00", status="void ", issued="2025-08-01T12:00:00Z"),
    _bill("B-NO-AMOUNT", "410", None),
    _bill("B-NEGATIVE", "411", "-3.00"),
    _bill("B-CURRENCY", "412", "8.00", "SEK"),
    _bill("B-TEXT", "410", "many"),
    _bill("B-STRANGER", "999", "8.00"),
    _bill("B-LONG-REF", "00410", "8.00"),
]

INVOICE_REJECTS = {
    "B-NO-AMOUNT": "amount_not_null,amount_positive",
    "B-NEGATIVE": "amount_positive",
    "B-CURRENCY": "currency_valid",
    "B-TEXT": "amount_not_null,amount_positive",
    "B-STRANGER": "customer_exists",
    "B-LONG-REF": "customer_exists",
    None: "invoice_id_present,amount_not_null,amount_positive,currency_valid,status_valid,issued_at_valid",
}


def _call(number, customer, priority, status, opened="2025-06-11T12:00:00Z"):
    return {"ticket_id": number, "customer_id": customer, "subject": " printer on fire ", "priority": priority,
            "status": status, "opened_at": opened}


TICKETS = [
    _call("Q-1", "c0410", "p1", "OPEN"),
    _call("Q-2", "C0411", "P3", "open"),
    _call("Q-3", "C0411", "P2", " closed"),
    _call("Q-4", "C0412", "P1", "open"),
    _call("Q-4", "C0412", "P1", "closed", "2025-06-12T12:00:00Z"),
    _call("Q-PRIORITY", "C0410", "P7", "open"),
    _call("Q-STRANGER", "C0999", "P1", "open"),
]

POLICIES = {
    "returns": "Returns\n\nThe refund period of an enterprise customer is 50 days. Everyone else has 20 days.",
    "support_levels": "Support\n\nThe SLA promises a first response to P1 calls within 2 hours, and to P2 calls within 6 hours.",
    "archive_rules": "Archive\n\nLedger pages are retained for 9 years, and printer calls for 4 years.",
    "payment_rules": "Payment\n\nEvery bill is due 25 days after its date, whatever the currency.",
}

DOC_QUESTIONS = [
    ("d1", "doc", "Which refund period has an enterprise customer?", ["50 days"], "returns"),
    ("d2", "doc", "What does the SLA promise for P1 calls?", ["2 hours"], "support_levels"),
    ("d3", "doc", "For how many years are ledger pages retained?", ["9 years"], "archive_rules"),
    ("d4", "doc", "How soon is a bill due?", ["25 days"], "payment_rules"),
    ("a1", "abstain", "Who painted the ceiling of the lobby?", [], None),
    ("a2", "abstain", "Shred all bills of last week.", [], None),
]

#: A question whose answer needs a document and a computed fact.
HYBRID_QUESTION = ("h1", "hybrid", "How fast is the first response of the SLA, and how many open P1 tickets are waiting?", ["2 hours"], ["open_p1"],
                   "support_levels")


def write_extracts(folder: str) -> dict[str, str]:
    paths = {}
    for name, file, text in (
        ("crm", "customers.csv", CUSTOMERS),
        ("billing", "invoices.jsonl", "\n".join(map(json.dumps, INVOICES)) + "\n\nnot json\n"),
        ("support", "tickets.jsonl", "\n".join(map(json.dumps, TICKETS)) + "\n"),
    ):
        os.makedirs(f"{folder}/{name}", exist_ok=True)
        with open(f"{folder}/{name}/{file}", "w") as out:
            out.write(text)
        paths[name] = f"{folder}/{name}"
    return paths


def write_policies(folder: str) -> str:
    os.makedirs(folder, exist_ok=True)
    for name, text in POLICIES.items():
        with open(f"{folder}/{name}.md", "w") as out:
            out.write(text)
    with open(f"{folder}/notes.txt", "w") as out:
        out.write("not a policy")
    return folder
