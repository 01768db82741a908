"""Small invented raw files with the edge cases each reader must handle."""

import json
from pathlib import Path

APPLICANTS = {
    "April2019.csv": """id,name,gender,dob,email,city,address,postcode,phone_number,uni,degree,invited_date,month,invited_by
1,Ada O'Test,Female,04/08/1994,ada@example.com,Town,1 Road,AA1 1AA,+44 (718) 555 0101,Uni A,2:1,10.0,April 2019,Rec One
2,Ben Demo-Case,Male,,ben@example.com,Town,2 Road,AA1 1AB,,Uni B,1st,,,Fifi Etton
3,Cy Sample,,12/01/1995,,,N/A,,,"Uni ""B"", north",3rd,,,
4,Dee Back\\slash,Female,01/02/1990,,Town,1 Road,AA1 1AA,,,,,May 2019,Rec One
""",
    "Sept2019.csv": """id,name,gender,dob,email,city,address,postcode,phone_number,uni,degree,invited_date,month,invited_by
1,Eve Early,Female,1994-08-04,,,,,,,,,,Fifi Eton
2,Ada O'Test,Female,04/08/1994,ada@example.com,Town,1 Road,AA1 1AA,,Uni A,2:1,5.0,SEPT 2019,Bruno Belbrook
""",
}

TALENT = {
    "10383": {
        "name": "Ada O'Test",
        "date": "01//05/2019",
        "tech_self_score": {"Java": 3, "C#": 2},
        "strengths": ["Patient", "Curious"],
        "weaknesses": ["Impatient"],
        "self_development": "Yes",
        "geo_flex": "No",
        "financial_support_self": "Yes",
        "result": "Pass",
        "course_interest": "Data",
    },
    "9999": {
        "name": "ada o'test",
        "date": "1/05/2019",
        "tech_self_score": {"Python": 5},
        "strengths": ["Curious", "Kind"],
        "weaknesses": [],
        "self_development": "Maybe",
        "geo_flex": "Yes",
        "financial_support_self": "No",
        "result": "Fail",
        "course_interest": "Business",
    },
    "11000": {"name": "Zoe Nodate", "date": None, "strengths": [], "weaknesses": ["Late", None], "result": "Pass"},
    "12000": {
        "name": "Mary-Ann Smith-Jones",
        "date": "01/05/2019",
        "strengths": ["Kind"],
        "weaknesses": ["Late", "Late"],
        "result": "Fail",
        "course_interest": "Data",
    },
}

REPORTS = {
    "Day 1.txt": "Wednesday 1 May 2019\r\nNorthtown Academy\r\n\r\n"
    "ADA O'TEST -  Psychometrics: 51/100, Presentation: 19/32\r\n"
    "MARY-ANN SMITH-JONES -  Psychometrics: 100/100, Presentation: 7/32\r\n"
    "CHER, -  Psychometrics: 40/100, Presentation: 8/32\r\n"
    "NO DASH HERE\r\n"
    "NO SCORE - Psychometrics: none\r\n",
    "Day2.txt": "Thursday 12 September 2019\nSouthport Academy\n\n"
    "ADA O'TEST -  Psychometrics: 60/100, Presentation: 20/32\n"
    "LAST PERSON -  Psychometrics: 1/100, Presentation: 2/32",
}

ACADEMY = {
    "Data_28_2019-06-03.csv": """name,trainer,Analytic_W1,Independent_W1,Determined_W1,Professional_W1,Studious_W1,Imaginative_W1,Analytic_W2,Independent_W2,Determined_W2,Professional_W2,Studious_W2,Imaginative_W2
Ada O'Test,Ely Kely,1,2,3,4,5,6,2,2,2,2,2,
Mary-Ann Smith-Jones,Elly Kelly,3,3,3,3,3,3,,,,,,
""",
    "Business_29_2019-07-01.csv": """trainer,name,Imaginative_W1,Analytic_W1,Independent_W1,Determined_W1,Professional_W1,Studious_W1
Tom Trainer,Ada O'Test,6,1,2,3,4,5
,Gus Guest,1,1,1,1,1,1
""",
    "Data_30_2019-10-07.csv": """name,trainer,Analytic_W1,Independent_W1,Determined_W1,Professional_W1,Studious_W1,Imaginative_W1
Ada O'Test,Tom Trainer,7,7,7,7,7,7
""",
}


def write_raw(root: Path) -> str:
    talent, academy = root / "Talent", root / "Academy"
    talent.mkdir(parents=True)
    academy.mkdir()
    for name, text in {**APPLICANTS, **REPORTS}.items():
        (talent / name).write_bytes(text.encode())
    for key, record in TALENT.items():
        (talent / f"{key}.json").write_text(json.dumps(record, indent=1))
    (talent / "77.json").write_text('{"name": "Broken')
    for name, text in ACADEMY.items():
        (academy / name).write_text(text)
    return str(root)
