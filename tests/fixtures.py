"""Small inputs written by hand or by rule."""

import os

# (employee id, name, department, days present), to test the rules: two people share a name, one comes on fewer days, names of
# two to nine letters on both sides of the length limits, and one name with the marker.
STAFF = [
    ("E1", "Tomas", "Accounts", 5),
    ("E2", "Bettina", "Accounts", 5),
    ("E3", "Luis", "Accounts", 5),
    ("E4", "Henrike", "Accounts", 5),
    ("E5", "Sam", "Accounts", 5),
    ("E6", "Sam", "Accounts", 5),
    ("E7", "Noemi", "Accounts", 5),
    ("E8", "Ulrike", "Accounts", 5),
    ("E9", "Arvid", "Accounts", 3),
    ("F1", "Vera", "HR", 4),
    ("F2", "Bo", "HR", 4),
    ("G1", "Dirk", "Finance", 2),
]

CITIES = {"E1": "Lund", "E2": "Graz", "X9": "Turku"}


def write(folder, name, lines):
    path = os.path.join(str(folder), name)
    with open(path, "w", newline="") as file:
        file.write("\n".join(lines))
    return path


def attendance(folder):
    depts = {"Accounts": 10, "HR": 20, "Finance": 30}
    lines = [f"{i},{n},{depts[d]},{d},{day}-01-2019" for i, n, d, days in STAFF for day in range(1, days + 1)]
    return write(folder, "attendance.txt", lines)


def location(folder):
    lines = [f"{i},555-01{i},{city}" for i, city in CITIES.items()]
    return write(folder, "location.txt", lines + lines[:1])


CARD_LINES = [
    "customer_id, first_name, last_name, relationship_id, card_type, max_limit, spent, cash, cleared, payment_date",
    # half of the limit spent, under 70 % of it cleared: short payment, 1 point
    "C1,Nils,Berg,R_1,Gold,800,400,10,279,15-03-2021",
    # whole limit spent, 300 cleared: both rules, 3 points
    "C1,Nils,Berg,R_1,Gold,800,800,0,500,15-04-2021",
    # exactly 70 % cleared, limit not reached: no point
    "C2,Ann,Lee,R_2,Gold,200,100,0,70,30-01-2018",
    # whole limit, cleared in full: no point
    "C2,Ann,Lee,R_2,Gold,200,200,0,200,28-02-2018",
    # whole limit, 80 % cleared: 1 point
    "C3,Bo,Kim,R_3,Gold,100,100,0,80,30-01-2018",
    # whole limit, overpaid: a point only if overpayment counts
    "C4,Cy,Fox,R_4,Gold,100,100,0,120,30-01-2018",
    # unreadable amount and too short a row: rejects
    "C5,Di,Ray,R_5,Gold,100,lots,0,120,30-01-2018",
    "C6,Ed,Poe",
]


def loan_line(customer, category, due, paid, first="Al", last="Day"):
    return f"{customer},{first},{last},Self,LN_{customer},{category},{due}, 2000, {paid}"


def loan_lines():
    lines = ["customer_id,first_name,last_name,customer_type,loan_id,category,due,amount,paid"]
    medical = lambda who, *pairs: [loan_line(who, " Medical Loan ", d, p) for d, p in pairs]
    late, in_time = ("26-01-2018", "30-01-2018"), ("26-02-2018", " 26-02-2018")
    lines += medical("M2", late, late, in_time)
    lines += medical("M3", late, late, late, in_time)
    lines += medical("M4", late, late, ("26-03-2018", "soon"), late)
    for who, months in PERSONAL.items():
        lines += [loan_line(who, "Personal Loan", f"05-{m:02d}-2018", f"{m}-{m:02d}-2018") for m in months]
    return lines


ALL_MONTHS = list(range(1, 13))
# Months with a payment; a repeated month counts once.
PERSONAL = {
    "P0": ALL_MONTHS + [5, 5],
    "PSTART": ALL_MONTHS[2:],
    "PMID": [m for m in ALL_MONTHS if m not in (5, 6)],
    "PEND": ALL_MONTHS[:-2],
    "PONE": [m for m in ALL_MONTHS if m not in (5,)],
    "P3": [m for m in ALL_MONTHS if m not in (3, 6, 9)],
    "P4": [m for m in ALL_MONTHS if m not in (3, 6, 9, 11)],
}


def kill_line(seconds=15, rank=9, prey_rank=4, place="P_1", prey_place="P_2", at="1700000001", who="W1", team="T9"):
    """A kill that is worth 4 points for the time, 2 for the ranks and 3 for the places, unless told otherwise."""
    prey = f"V2,Second,T8,Others,Sling,{prey_rank},{prey_place}"
    return f"G7,{who},First,{team},Ones,Spear,{rank},{place},{prey},{seconds},{at}"


def sales_lines():
    """Store 1: 12 sales in the wanted cities, store 2: 7, and some elsewhere."""
    lines = ["store_id, location, product_id, category, pieces, buy, sell"]
    for i in range(12):
        lines.append(f"STR_1,Mumbai,PR_{i},Toys,{i + 1},10,{12 + i % 3}")
        if i < 7:
            lines.append(f"STR_2,Bangalore,PR_{i},Toys,2,20,{19 + i}")
        if i % 4 == 0:
            lines.append(f"STR_3,Pune,PR_{i},Toys,9,1,100")
    return lines
