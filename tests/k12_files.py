"""A small two-district data set written by hand."""

from __future__ import annotations

import csv
from pathlib import Path

NS = 'xmlns="http://ed-fi.org/0220"'


def interchange(name: str, body: str) -> str:
    return f'<?xml version="1.0" encoding="UTF-8"?>\n<Interchange{name} {NS}>\n{body}\n</Interchange{name}>\n'


def ref(kind: str, tag: str, value: str) -> str:
    return f"<{kind}Reference><{tag}>{value}</{tag}></{kind}Reference>"


def student(sid: str) -> str:
    return ref("Student", "StudentUniqueId", sid)


def school(sid: str) -> str:
    return ref("School", "SchoolId", sid)


def item(q, code, right, given, hint="") -> str:
    hint = f"<MisconceptionIndicator>{hint}</MisconceptionIndicator>" if hint else ""
    given = f"<StudentAnswer>{given}</StudentAnswer>" if given is not None else ""
    return (
        f"<StudentAssessmentItem><QuestionNumber>{q}</QuestionNumber><LearningStandardCode>{code}</LearningStandardCode>"
        f"<CorrectAnswer>{right}</CorrectAnswer>{given}{hint}</StudentAssessmentItem>"
    )


def assessment(aid, sid, code, score, items="") -> str:
    return (
        f"<StudentAssessment><AssessmentIdentifier>{aid}</AssessmentIdentifier>{student(sid)}"
        f"<StandardCode>{code}</StandardCode><ScoreResult>{score}</ScoreResult>{items}</StudentAssessment>"
    )


def attendance(sid, day, status) -> str:
    return (
        f"<StudentSchoolAttendanceEvent>{student(sid)}{school('SCH-1')}<EventDate>{day}</EventDate>"
        f"<AttendanceEventCategory>{status}</AttendanceEventCategory></StudentSchoolAttendanceEvent>"
    )


XML = {
    "Students.xml": interchange(
        "Student",
        """<Student id="a"><StudentUniqueId> S1 </StudentUniqueId><FirstName>Ann</FirstName><LastSurname>Lee</LastSurname>
             <BirthDate>2015-03-14</BirthDate><Email>ann@example.com</Email></Student>
           <Student><StudentUniqueId></StudentUniqueId><FirstName>Bob</FirstName><LastSurname>   </LastSurname>
             <BirthDate>soon</BirthDate></Student>
           <Student><StudentUniqueId>S3</StudentUniqueId><FirstName>Cy &amp; Co</FirstName><LastSurname>Wu</LastSurname>
             <BirthDate>2014-07-22</BirthDate><Email>cy@example.com</Email></Student>""",
    ),
    "Schools.xml": interchange(
        "EducationOrganization",
        """<School><SchoolId>SCH-1</SchoolId><SchoolName>First</SchoolName><SchoolType>Elementary</SchoolType>
             <GradeBandLow>0</GradeBandLow><DistrictId>D1</DistrictId><DistrictName>North</DistrictName></School>
           <School><SchoolId>SCH-2</SchoolId><SchoolName>Second</SchoolName></School>""",
    ),
    "Staff.xml": interchange(
        "Staff",
        """<Staff><StaffUniqueId>T1</StaffUniqueId><FirstName> Dee </FirstName><LastSurname>Fox</LastSurname>
             <Email>DEE@example.com</Email></Staff>""",
    ),
    "Sections.xml": interchange(
        "MasterSchedule",
        """<Section><SectionIdentifier>SEC-1</SectionIdentifier><CourseOfferingReference><CourseName>Kindergarten Math</CourseName>
             <GradeLevel>K</GradeLevel></CourseOfferingReference><SchoolReference><SchoolId>SCH-1</SchoolId></SchoolReference>
             <CurriculumVersion>A</CurriculumVersion></Section>
           <Section><SectionIdentifier>SEC-2</SectionIdentifier><CourseOfferingReference><CourseName>ELA 3</CourseName>
             </CourseOfferingReference><SchoolReference><SchoolId>SCH-1</SchoolId></SchoolReference></Section>""",
    ),
    "StudentSchoolAssociations.xml": interchange(
        "StudentEnrollment",
        "\n".join(
            f"<StudentSchoolAssociation>{student(s)}{school(c)}<EntryDate>{d}</EntryDate>"
            f"<EntryGradeLevelDescriptor>{g}</EntryGradeLevelDescriptor></StudentSchoolAssociation>"
            for s, c, d, g in (
                ("S1", "SCH-1", "2025-08-15", "First grade"),
                ("S3", "INVALID-SCH-999", "2027-09-01", "Grade 6"),
                ("", "SCH-2", "2025-08-15", "Kindergarten"),
            )
        ),
    ),
    "StudentSectionAssociations.xml": interchange(
        "StudentEnrollment",
        "\n".join(
            f"<StudentSectionAssociation>{student(s)}<SectionReference><SectionIdentifier>{c}</SectionIdentifier>"
            f"{school('SCH-1')}</SectionReference></StudentSectionAssociation>"
            for s, c in (("S1", "SEC-1"), ("S3", "DANGLING-SEC-999"))
        ),
    ),
    "Grades.xml": interchange(
        "StudentGrade",
        f"""<Grade>{student("S1")}<SectionReference><SectionIdentifier>SEC-1</SectionIdentifier></SectionReference>
            <GradingPeriod>Q1</GradingPeriod><NumericGrade>88</NumericGrade></Grade>""",
    ),
    "StudentAssessments.xml": interchange(
        "StudentAssessment",
        "\n".join(
            (
                assessment("A1", "S1", "STD-1", "72.5", item(1, "", "4", "4") + item(2, "STD-2", "7", "3", "swap")),
                assessment("A2", "S1", "STD-1", "40", item(1, "STD-1", "4", "5", "swap")),
                assessment("A3", "S3", "STD-1", "95"),
                assessment("A4", "S3", "STD-1", "n/a", item(1, "STD-1", "4", None)),
                assessment("A5", "S3", "STD-1", "49.9", item(1, "STD-1", "4", "4", "swap")),
                "<StudentAssessment><AssessmentIdentifier>A6</AssessmentIdentifier><Broken></StudentAssessment>",
                assessment("A7", "S3", "STD-2", "20", item(1, "STD-2", "7", "8", "unknown")),
            )
        ),
    ),
    "StudentSchoolAttendanceEvents.xml": interchange(
        "StudentAttendance",
        "\n".join([attendance("S1", f"2025-09-{d:02d}", "Present") for d in range(1, 10)])
        + attendance("S1", "2025-09-10", "Tardy")
        + attendance("S3", "2025-09-01", "Absent")
        + attendance("S3", "2025-09-02", "Present"),
    ),
    "LearningStandards.xml": interchange(
        "AssessmentMetadata",
        """<LearningStandard><StandardCode>STD-1</StandardCode><StandardDescription>Count</StandardDescription>
             <Domain>Numbers</Domain></LearningStandard>""",
    ),
}

CSV = {
    "users.csv": (
        "sourcedId,status,dateLastModified,enabledUser,username,givenName,familyName,middleName,identifier,email,sms,phone,role,grades,password",
        ("u1,active,,true,u1,Eve,Ray,,1,eve@example.org,,,student,03,", "u2,active,,true,u2,Flo,Day,,2,,,,teacher,,"),
    ),
    "orgs.csv": (
        "sourcedId,status,dateLastModified,name,type,identifier,parentSourcedId",
        ("o1,active,,Hill School,school,SCH-9,od1", "od1,active,,South,district,D9,"),
    ),
    "classes.csv": (
        "sourcedId,status,dateLastModified,title,grades,courseSourcedId,classCode,classType,location,schoolSourcedId,termSourcedIds,subjects,subjectCodes,periods",
        ('c1,active,,"Math, period 1",03,co1,MATH-3-B,scheduled,,o1,"t1,t2",,,', "c2,active,,Art,Grade 6,co9,ART,scheduled,,o1,,,,"),
    ),
    "courses.csv": (
        "sourcedId,status,dateLastModified,schoolYearSourcedId,title,courseCode,grades,orgSourcedId,subjects,subjectCodes",
        ("co1,active,,y1,Math 3,M3,03,od1,,",),
    ),
    "enrollments.csv": (
        "sourcedId,status,dateLastModified,classSourcedId,schoolSourcedId,userSourcedId,role,primary,beginDate,endDate",
        (
            "e1,active,,c1,o1,u1,student,false,2025-08-20,",
            "e2,active,,c2,o1,u1,student,false,2025-08-20,",
            "e3,active,,c1,o1,u2,teacher,true,2025-08-20,",
        ),
    ),
    "academicSessions.csv": (
        "sourcedId,status,dateLastModified,title,type,startDate,endDate,parentSourcedId,schoolYear",
        ("t1,active,,Fall,semester,2025-08-15,2025-12-20,y1,2026",),
    ),
    "lineItems.csv": (
        "sourcedId,status,dateLastModified,title,description,assignDate,dueDate,classSourcedId,categorySourcedId,resultValueMin,resultValueMax",
        ("l1,active,,Quiz,,2025-09-01,2025-09-02,c1,,0,100",),
    ),
    "results.csv": (
        "sourcedId,status,dateLastModified,lineItemSourcedId,studentSourcedId,scoreStatus,score,scoreDate,comment,question_number,standard_code,correct_answer,student_answer,misconception_indicator",
        (
            "r1,active,,l1,u1,fully graded,60,2025-09-02,,1,STD-1,4,5,swap",
            "r2,active,,l1,u1,fully graded,55,2025-09-09,,1,STD-1,4,4,",
            "r3,active,,l1,u1,fully graded,91,2025-09-05,,1,STD-2,7,7,",
        ),
    ),
    "demographics.csv": (
        "sourcedId,status,dateLastModified,birthDate,sex,americanIndianOrAlaskaNative,asian,blackOrAfricanAmerican,nativeHawaiianOrOtherPacificIslander,white,demographicRaceTwoOrMoreRaces,hispanicOrLatinoEthnicity",
        ("u1,active,,2013-01-31,female,false,false,false,false,true,false,false",),
    ),
}

SEEDS = {
    "seed_school_registry.csv": (
        ("school_id", "school_name", "school_type", "grade_band_low", "grade_band_high", "district_id", "district_name", "source_system"),
        (("SCH-1", "First", "Middle", 2, 5, "DX", "Other", "edfi"), ("SCH-2", "Second", "Elementary", 0, 5, "D1", "North", "edfi"),
         ("SCH-9", "Hill School", "High", 9, 12, "D9", "South", "oneroster")),
    ),
    "seed_learning_standards.csv": (
        ("standard_code", "standard_description", "domain", "grade_level", "prerequisite_standard_code", "subject"),
        (("STD-1", "Count, by ones", "Numbers", 0, "", "Math"), ("STD-2", "Add", "Operations", 1, "STD-1", "Math")),
    ),
    "seed_misconception_patterns.csv": (
        ("misconception_id", "standard_code", "pattern_label", "description", "suggested_reteach", "wrong_answer_pattern"),
        (("MC-1", "STD-1", "swap", "Swaps digits", "Lesson 1", "b/a"), ("MC-2", "STD-2", "swap", "Swaps terms", "Lesson 2", "b-a")),
    ),
}


def write(root: Path) -> tuple[str, str, str]:
    """Write everything below ``root``; returns the XML, CSV and seed folders."""
    folders = [root / name for name in ("xml", "csv", "seeds")]
    for folder in folders:
        folder.mkdir(parents=True, exist_ok=True)
    for name, text in XML.items():
        (folders[0] / name).write_text(text)
    for name, (header, lines) in CSV.items():
        (folders[1] / name).write_text("\n".join([header, *lines]) + "\n")
    for name, (header, lines) in SEEDS.items():
        with open(folders[2] / name, "w", newline="") as out:
            csv.writer(out).writerows([header, *lines])
    return tuple(str(f) for f in folders)
