"""Lookup tables of the labour-market model.

Everything in this module is a fixed value: the results depend on these exact
words and codes, so they are stated as plain text. Each table is a default
argument of the operator that uses it and can be replaced by the caller.
"""

from __future__ import annotations

# Curated job title -> (occupation code, occupation title).
SOC_TITLE_SEED = [
    ("software engineer", "15-1252", "Software Developers"),
    ("software developer", "15-1252", "Software Developers"),
    ("software engineer intern", "15-1252", "Software Developers"),
    ("full stack engineer", "15-1254", "Web Developers"),
    ("full stack developer", "15-1254", "Web Developers"),
    ("frontend engineer", "15-1254", "Web Developers"),
    ("frontend developer", "15-1254", "Web Developers"),
    ("backend engineer", "15-1252", "Software Developers"),
    ("backend developer", "15-1252", "Software Developers"),
    ("mobile developer", "15-1252", "Software Developers"),
    ("ios developer", "15-1252", "Software Developers"),
    ("android developer", "15-1252", "Software Developers"),
    ("web developer", "15-1254", "Web Developers"),
    ("data engineer", "15-2051", "Data Scientists"),
    ("data scientist", "15-2051", "Data Scientists"),
    ("machine learning engineer", "15-2051", "Data Scientists"),
    ("ml engineer", "15-2051", "Data Scientists"),
    ("data analyst", "15-2041", "Statisticians"),
    ("data analyst entry level", "15-2041", "Statisticians"),
    ("business analyst", "13-1111", "Management Analysts"),
    ("business intelligence analyst", "15-2041", "Statisticians"),
    ("database administrator", "15-1242", "Database Administrators"),
    ("database engineer", "15-1242", "Database Administrators"),
    ("systems analyst", "15-1211", "Computer Systems Analysts"),
    ("systems administrator", "15-1244", "Network and Computer Systems Administrators"),
    ("network engineer", "15-1241", "Computer Network Architects"),
    ("network administrator", "15-1244", "Network and Computer Systems Administrators"),
    ("cloud engineer", "15-1244", "Network and Computer Systems Administrators"),
    ("devops engineer", "15-1244", "Network and Computer Systems Administrators"),
    ("site reliability engineer", "15-1244", "Network and Computer Systems Administrators"),
    ("security engineer", "15-1212", "Information Security Analysts"),
    ("cybersecurity analyst", "15-1212", "Information Security Analysts"),
    ("information security analyst", "15-1212", "Information Security Analysts"),
    ("qa engineer", "15-1253", "Software Quality Assurance Analysts and Testers"),
    ("quality assurance engineer", "15-1253", "Software Quality Assurance Analysts and Testers"),
    ("test engineer", "15-1253", "Software Quality Assurance Analysts and Testers"),
    ("product manager", "11-3021", "Computer and Information Systems Managers"),
    ("technical program manager", "11-3021", "Computer and Information Systems Managers"),
    ("it support specialist", "15-1232", "Computer User Support Specialists"),
    ("help desk analyst", "15-1232", "Computer User Support Specialists"),
    ("junior developer", "15-1252", "Software Developers"),
    ("new grad software", "15-1252", "Software Developers"),
    ("research scientist", "15-2099", "Mathematical Science Occupations, All Other"),
    ("statistician", "15-2041", "Statisticians"),
    ("accountant", "13-2011", "Accountants and Auditors"),
    ("auditor", "13-2011", "Accountants and Auditors"),
    ("financial analyst", "13-2051", "Financial and Investment Analysts"),
    ("budget analyst", "13-2031", "Budget Analysts"),
    ("management analyst", "13-1111", "Management Analysts"),
    ("hr specialist", "13-1071", "Human Resources Specialists"),
    ("human resources specialist", "13-1071", "Human Resources Specialists"),
    ("marketing specialist", "13-1161", "Market Research Analysts and Marketing Specialists"),
    ("marketing manager", "11-2021", "Marketing Managers"),
    ("project manager", "13-1082", "Project Management Specialists"),
    ("registered nurse", "29-1141", "Registered Nurses"),
    ("nurse practitioner", "29-1171", "Nurse Practitioners"),
    ("physician", "29-1228", "Physicians, All Other"),
    ("medical assistant", "31-9092", "Medical Assistants"),
    ("physical therapist", "29-1123", "Physical Therapists"),
    ("pharmacist", "29-1051", "Pharmacists"),
    ("dentist", "29-1021", "Dentists, General"),
    ("attorney", "23-1011", "Lawyers"),
    ("lawyer", "23-1011", "Lawyers"),
    ("paralegal", "23-2011", "Paralegals and Legal Assistants"),
    ("teacher", "25-2021", "Elementary School Teachers"),
    ("elementary teacher", "25-2021", "Elementary School Teachers"),
    ("high school teacher", "25-2031", "Secondary School Teachers"),
    ("professor", "25-1099", "Postsecondary Teachers, All Other"),
    ("sales associate", "41-2031", "Retail Salespersons"),
    ("account executive", "41-3091", "Sales Representatives of Services"),
    ("customer service representative", "43-4051", "Customer Service Representatives"),
    ("administrative assistant", "43-6014", "Secretaries and Administrative Assistants"),
    ("executive assistant", "43-6011", "Executive Secretaries and Executive Administrative Assistants"),
    ("electrician", "47-2111", "Electricians"),
    ("plumber", "47-2152", "Plumbers, Pipefitters, and Steamfitters"),
    ("carpenter", "47-2031", "Carpenters"),
    ("mechanic", "49-3023", "Automotive Service Technicians and Mechanics"),
    ("information technology specialist", "15-1212", "Information Security Analysts"),
    ("it specialist", "15-1212", "Information Security Analysts"),
    ("contract specialist", "13-1023", "Purchasing Agents"),
    ("program analyst", "13-1111", "Management Analysts"),
    ("management and program analyst", "13-1111", "Management Analysts"),
    ("intelligence analyst", "33-3021", "Detectives and Criminal Investigators"),
    ("police officer", "33-3051", "Police and Sheriff Patrol Officers"),
    ("park ranger", "33-3052", "Transit and Railroad Police"),
]

# Title substring -> (occupation code, occupation title).
SOC_TITLE_PATTERNS = [
    ("machine learning", "15-2051", "Data Scientists"),
    ("data science", "15-2051", "Data Scientists"),
    ("data scientist", "15-2051", "Data Scientists"),
    ("data engineer", "15-2051", "Data Scientists"),
    ("data analyst", "15-2041", "Statisticians"),
    ("database", "15-1242", "Database Administrators"),
    ("cybersecurity", "15-1212", "Information Security Analysts"),
    ("cyber security", "15-1212", "Information Security Analysts"),
    ("information security", "15-1212", "Information Security Analysts"),
    ("information assurance", "15-1212", "Information Security Analysts"),
    ("network engineer", "15-1241", "Computer Network Architects"),
    ("network admin", "15-1244", "Network and Computer Systems Administrators"),
    ("system admin", "15-1244", "Network and Computer Systems Administrators"),
    ("systems admin", "15-1244", "Network and Computer Systems Administrators"),
    ("cloud", "15-1244", "Network and Computer Systems Administrators"),
    ("devops", "15-1244", "Network and Computer Systems Administrators"),
    ("site reliability", "15-1244", "Network and Computer Systems Administrators"),
    ("quality assurance", "15-1253", "Software Quality Assurance Analysts and Testers"),
    ("software quality", "15-1253", "Software Quality Assurance Analysts and Testers"),
    ("test engineer", "15-1253", "Software Quality Assurance Analysts and Testers"),
    ("qa engineer", "15-1253", "Software Quality Assurance Analysts and Testers"),
    ("web developer", "15-1254", "Web Developers"),
    ("frontend", "15-1254", "Web Developers"),
    ("front end", "15-1254", "Web Developers"),
    ("front-end", "15-1254", "Web Developers"),
    ("full stack", "15-1254", "Web Developers"),
    ("full-stack", "15-1254", "Web Developers"),
    ("software developer", "15-1252", "Software Developers"),
    ("software engineer", "15-1252", "Software Developers"),
    ("software", "15-1252", "Software Developers"),
    ("developer", "15-1252", "Software Developers"),
    ("programmer", "15-1251", "Computer Programmers"),
    ("information technology", "15-1212", "Information Security Analysts"),
    ("it specialist", "15-1212", "Information Security Analysts"),
    ("contract specialist", "13-1023", "Purchasing Agents"),
    ("contracting", "13-1023", "Purchasing Agents"),
    ("purchasing", "13-1023", "Purchasing Agents"),
    ("acquisition", "13-1023", "Purchasing Agents"),
    ("procurement", "13-1023", "Purchasing Agents"),
    ("logistics", "13-1081", "Logisticians"),
    ("supply chain", "13-1081", "Logisticians"),
    ("management analyst", "13-1111", "Management Analysts"),
    ("management and program", "13-1111", "Management Analysts"),
    ("program analyst", "13-1111", "Management Analysts"),
    ("policy analyst", "13-1111", "Management Analysts"),
    ("budget", "13-2031", "Budget Analysts"),
    ("financial analyst", "13-2051", "Financial and Investment Analysts"),
    ("financial management", "13-2051", "Financial and Investment Analysts"),
    ("accountant", "13-2011", "Accountants and Auditors"),
    ("accounting", "13-2011", "Accountants and Auditors"),
    ("auditor", "13-2011", "Accountants and Auditors"),
    ("audit", "13-2011", "Accountants and Auditors"),
    ("human resources", "13-1071", "Human Resources Specialists"),
    ("hr specialist", "13-1071", "Human Resources Specialists"),
    ("personnel", "13-1071", "Human Resources Specialists"),
    ("equal employment", "13-1041", "Compliance Officers"),
    ("eeo", "13-1041", "Compliance Officers"),
    ("compliance", "13-1041", "Compliance Officers"),
    ("marketing", "13-1161", "Market Research Analysts and Marketing Specialists"),
    ("public affairs", "27-3031", "Public Relations Specialists"),
    ("public relations", "27-3031", "Public Relations Specialists"),
    ("communications", "27-3031", "Public Relations Specialists"),
    ("writer", "27-3043", "Writers and Authors"),
    ("editor", "27-3041", "Editors"),
    ("translator", "27-3091", "Interpreters and Translators"),
    ("interpreter", "27-3091", "Interpreters and Translators"),
    ("project manager", "13-1082", "Project Management Specialists"),
    ("project management", "13-1082", "Project Management Specialists"),
    ("program manager", "11-9199", "Managers, All Other"),
    ("product manager", "11-3021", "Computer and Information Systems Managers"),
    ("registered nurse", "29-1141", "Registered Nurses"),
    ("nurse practitioner", "29-1171", "Nurse Practitioners"),
    ("nursing assistant", "31-1131", "Nursing Assistants"),
    ("practical nurse", "29-2061", "Licensed Practical and Vocational Nurses"),
    ("nurse", "29-1141", "Registered Nurses"),
    ("physician assistant", "29-1071", "Physician Assistants"),
    ("physician", "29-1228", "Physicians, All Other"),
    ("medical doctor", "29-1228", "Physicians, All Other"),
    ("psychiatrist", "29-1223", "Psychiatrists"),
    ("psychologist", "19-3033", "Clinical, Counseling, and School Psychologists"),
    ("social worker", "21-1029", "Social Workers, All Other"),
    ("counselor", "21-1019", "Counselors, All Other"),
    ("therapist", "29-1129", "Therapists, All Other"),
    ("occupational therapy", "29-1122", "Occupational Therapists"),
    ("physical therapy", "29-1123", "Physical Therapists"),
    ("respiratory therapy", "29-1126", "Respiratory Therapists"),
    ("speech", "29-1127", "Speech-Language Pathologists"),
    ("audiologist", "29-1181", "Audiologists"),
    ("pharmacist", "29-1051", "Pharmacists"),
    ("pharmacy", "29-2052", "Pharmacy Technicians"),
    ("dietitian", "29-1031", "Dietitians and Nutritionists"),
    ("nutritionist", "29-1031", "Dietitians and Nutritionists"),
    ("dental", "29-1021", "Dentists, General"),
    ("optometrist", "29-1041", "Optometrists"),
    ("chiropractor", "29-1011", "Chiropractors"),
    ("podiatrist", "29-1081", "Podiatrists"),
    ("veterinarian", "29-1131", "Veterinarians"),
    ("clinical laboratory", "29-2011", "Medical and Clinical Laboratory Technologists"),
    ("medical technologist", "29-2011", "Medical and Clinical Laboratory Technologists"),
    ("medical technician", "29-2012", "Medical and Clinical Laboratory Technicians"),
    ("radiologic", "29-2034", "Radiologic Technologists and Technicians"),
    ("diagnostic", "29-2032", "Diagnostic Medical Sonographers"),
    ("biomedical equipment", "49-9062", "Medical Equipment Repairers"),
    ("medical equipment", "49-9062", "Medical Equipment Repairers"),
    ("health technician", "29-2099", "Health Technologists and Technicians, All Other"),
    ("health system", "11-9111", "Medical and Health Services Managers"),
    ("health services", "11-9111", "Medical and Health Services Managers"),
    ("healthcare", "11-9111", "Medical and Health Services Managers"),
    ("medical assistant", "31-9092", "Medical Assistants"),
    ("medical record", "29-2071", "Medical Records Specialists"),
    ("health information", "29-2071", "Medical Records Specialists"),
    ("public health", "21-1094", "Community Health Workers"),
    ("epidemiologist", "19-1041", "Epidemiologists"),
    ("biologist", "19-1029", "Biological Scientists, All Other"),
    ("chemist", "19-2031", "Chemists"),
    ("microbiologist", "19-1022", "Microbiologists"),
    ("aerospace engineer", "17-2011", "Aerospace Engineers"),
    ("aeronautical", "17-2011", "Aerospace Engineers"),
    ("astronaut", "17-2011", "Aerospace Engineers"),
    ("civil engineer", "17-2051", "Civil Engineers"),
    ("mechanical engineer", "17-2141", "Mechanical Engineers"),
    ("electrical engineer", "17-2071", "Electrical Engineers"),
    ("electronics engineer", "17-2072", "Electronics Engineers"),
    ("industrial engineer", "17-2112", "Industrial Engineers"),
    ("biomedical engineer", "17-2031", "Bioengineers and Biomedical Engineers"),
    ("chemical engineer", "17-2041", "Chemical Engineers"),
    ("environmental engineer", "17-2081", "Environmental Engineers"),
    ("nuclear engineer", "17-2161", "Nuclear Engineers"),
    ("petroleum engineer", "17-2171", "Petroleum Engineers"),
    ("engineer", "17-2199", "Engineers, All Other"),
    ("research scientist", "19-1042", "Medical Scientists"),
    ("physicist", "19-2012", "Physicists"),
    ("geologist", "19-2042", "Geoscientists"),
    ("geoscientist", "19-2042", "Geoscientists"),
    ("hydrologist", "19-2043", "Hydrologists"),
    ("meteorologist", "19-2021", "Atmospheric and Space Scientists"),
    ("atmospheric", "19-2021", "Atmospheric and Space Scientists"),
    ("environmental scientist", "19-2041", "Environmental Scientists and Specialists"),
    ("soil scientist", "19-1013", "Soil and Plant Scientists"),
    ("forester", "19-1032", "Foresters"),
    ("forestry", "19-1032", "Foresters"),
    ("wildlife", "19-1023", "Zoologists and Wildlife Biologists"),
    ("fisheries", "19-1023", "Zoologists and Wildlife Biologists"),
    ("archaeologist", "19-3091", "Anthropologists and Archeologists"),
    ("historian", "19-3093", "Historians"),
    ("economist", "19-3011", "Economists"),
    ("statistician", "15-2041", "Statisticians"),
    ("mathematician", "15-2021", "Mathematicians"),
    ("actuary", "15-2011", "Actuaries"),
    ("analyst", "13-1111", "Management Analysts"),
    ("scientist", "19-1029", "Biological Scientists, All Other"),
    ("police officer", "33-3051", "Police and Sheriff Patrol Officers"),
    ("police", "33-3051", "Police and Sheriff Patrol Officers"),
    ("detective", "33-3021", "Detectives and Criminal Investigators"),
    ("criminal investigator", "33-3021", "Detectives and Criminal Investigators"),
    ("special agent", "33-3021", "Detectives and Criminal Investigators"),
    ("intelligence", "33-3021", "Detectives and Criminal Investigators"),
    ("targeting analyst", "33-3021", "Detectives and Criminal Investigators"),
    ("counterintelligence", "33-3021", "Detectives and Criminal Investigators"),
    ("correctional", "33-3012", "Correctional Officers and Jailers"),
    ("security officer", "33-9032", "Security Guards"),
    ("security guard", "33-9032", "Security Guards"),
    ("firefighter", "33-2011", "Firefighters"),
    ("fire", "33-2011", "Firefighters"),
    ("park ranger", "33-9092", "Lifeguards, Ski Patrol, and Other Recreational Protective Service Workers"),
    ("border patrol", "33-3051", "Police and Sheriff Patrol Officers"),
    ("customs", "33-3051", "Police and Sheriff Patrol Officers"),
    ("air traffic", "53-2021", "Air Traffic Controllers"),
    ("teacher", "25-2021", "Elementary School Teachers"),
    ("professor", "25-1099", "Postsecondary Teachers, All Other"),
    ("instructor", "25-1099", "Postsecondary Teachers, All Other"),
    ("librarian", "25-4022", "Librarians and Media Collections Specialists"),
    ("education", "25-9099", "Educational Instruction and Library Workers, All Other"),
    ("attorney", "23-1011", "Lawyers"),
    ("lawyer", "23-1011", "Lawyers"),
    ("counsel", "23-1011", "Lawyers"),
    ("judge", "23-1023", "Judges"),
    ("paralegal", "23-2011", "Paralegals and Legal Assistants"),
    ("legal", "23-2011", "Paralegals and Legal Assistants"),
    ("electrician", "47-2111", "Electricians"),
    ("plumber", "47-2152", "Plumbers, Pipefitters, and Steamfitters"),
    ("carpenter", "47-2031", "Carpenters"),
    ("mechanic", "49-3023", "Automotive Service Technicians and Mechanics"),
    ("maintenance", "49-9071", "Maintenance and Repair Workers, General"),
    ("truck driver", "53-3032", "Heavy and Tractor-Trailer Truck Drivers"),
    ("driver", "53-3032", "Heavy and Tractor-Trailer Truck Drivers"),
    ("aircraft mechanic", "49-3011", "Aircraft Mechanics and Service Technicians"),
    ("pilot", "53-2011", "Airline Pilots, Copilots, and Flight Engineers"),
    ("captain", "53-5021", "Captains, Mates, and Pilots of Water Vessels"),
    ("warehouse", "53-7065", "Stockers and Order Fillers"),
    ("administrative assistant", "43-6014", "Secretaries and Administrative Assistants"),
    ("executive assistant", "43-6011", "Executive Secretaries and Executive Administrative Assistants"),
    ("secretary", "43-6014", "Secretaries and Administrative Assistants"),
    ("clerk", "43-9061", "Office Clerks, General"),
    ("receptionist", "43-4171", "Receptionists and Information Clerks"),
    ("customer service", "43-4051", "Customer Service Representatives"),
    ("call center", "43-4051", "Customer Service Representatives"),
    ("data entry", "43-9021", "Data Entry Keyers"),
    ("supervisory", "11-9199", "Managers, All Other"),
    ("director", "11-9199", "Managers, All Other"),
    ("chief", "11-1011", "Chief Executives"),
    ("manager", "11-9199", "Managers, All Other"),
    ("specialist", "13-1199", "Business Operations Specialists, All Other"),
]

# Occupation major group -> title.
SOC_MAJOR_TITLES = [
    ("11-0000", "Management"),
    ("13-0000", "Business and Financial Operations"),
    ("15-0000", "Computer and Mathematical"),
    ("17-0000", "Architecture and Engineering"),
    ("19-0000", "Life, Physical, and Social Science"),
    ("21-0000", "Community and Social Service"),
    ("23-0000", "Legal"),
    ("25-0000", "Educational Instruction and Library"),
    ("27-0000", "Arts, Design, Entertainment, Sports, and Media"),
    ("29-0000", "Healthcare Practitioners and Technical"),
    ("31-0000", "Healthcare Support"),
    ("33-0000", "Protective Service"),
    ("35-0000", "Food Preparation and Serving"),
    ("37-0000", "Building and Grounds Cleaning and Maintenance"),
    ("39-0000", "Personal Care and Service"),
    ("41-0000", "Sales and Related"),
    ("43-0000", "Office and Administrative Support"),
    ("45-0000", "Farming, Fishing, and Forestry"),
    ("47-0000", "Construction and Extraction"),
    ("49-0000", "Installation, Maintenance, and Repair"),
    ("51-0000", "Production"),
    ("53-0000", "Transportation and Material Moving"),
    ("55-0000", "Military Specific"),
]

# State FIPS code -> display name.
STATE_FIPS_NAMES = [
    ("01", "Alabama"),
    ("02", "Alaska"),
    ("04", "Arizona"),
    ("05", "Arkansas"),
    ("06", "California"),
    ("08", "Colorado"),
    ("09", "Connecticut"),
    ("10", "Delaware"),
    ("11", "D.C."),
    ("12", "Florida"),
    ("13", "Georgia"),
    ("15", "Hawaii"),
    ("16", "Idaho"),
    ("17", "Illinois"),
    ("18", "Indiana"),
    ("19", "Iowa"),
    ("20", "Kansas"),
    ("21", "Kentucky"),
    ("22", "Louisiana"),
    ("23", "Maine"),
    ("24", "Maryland"),
    ("25", "Massachusetts"),
    ("26", "Michigan"),
    ("27", "Minnesota"),
    ("28", "Mississippi"),
    ("29", "Missouri"),
    ("30", "Montana"),
    ("31", "Nebraska"),
    ("32", "Nevada"),
    ("33", "New Hampshire"),
    ("34", "New Jersey"),
    ("35", "New Mexico"),
    ("36", "New York"),
    ("37", "North Carolina"),
    ("38", "North Dakota"),
    ("39", "Ohio"),
    ("40", "Oklahoma"),
    ("41", "Oregon"),
    ("42", "Pennsylvania"),
    ("44", "Rhode Island"),
    ("45", "South Carolina"),
    ("46", "South Dakota"),
    ("47", "Tennessee"),
    ("48", "Texas"),
    ("49", "Utah"),
    ("50", "Vermont"),
    ("51", "Virginia"),
    ("53", "Washington"),
    ("54", "West Virginia"),
    ("55", "Wisconsin"),
    ("56", "Wyoming"),
]

# Agency name substring -> parent abbreviation, first hit wins.
AGENCY_PARENTS = [
    ("department of defense", "DOD"),
    ("department of veterans affairs", "VA"),
    ("department of justice", "DOJ"),
    ("department of homeland security", "DHS"),
    ("department of state", "DOS"),
    ("health and human services", "HHS"),
    ("department of the treasury", "Treasury"),
    ("department of energy", "DOE"),
    ("department of transportation", "DOT"),
    ("department of labor", "DOL"),
    ("department of commerce", "DOC"),
    ("department of agriculture", "USDA"),
    ("department of the interior", "DOI"),
    ("department of education", "ED"),
    ("nasa", "NASA"),
    ("department of the air force", "USAF"),
    ("department of the army", "USA"),
    ("department of the navy", "USN"),
]

# Census region -> states. Anything else is 'Other'.
CENSUS_REGIONS = {
    "Northeast": [
        "Connecticut", "Maine", "Massachusetts", "New Hampshire", "Rhode Island",
        "Vermont", "New Jersey", "New York", "Pennsylvania",
    ],
    "Midwest": [
        "Indiana", "Illinois", "Michigan", "Ohio", "Wisconsin", "Iowa", "Kansas",
        "Minnesota", "Missouri", "Nebraska", "North Dakota", "South Dakota",
    ],
    "South": [
        "Delaware", "Florida", "Georgia", "Maryland", "North Carolina",
        "South Carolina", "Virginia", "District of Columbia", "West Virginia",
        "Alabama", "Kentucky", "Mississippi", "Tennessee", "Arkansas", "Louisiana",
        "Oklahoma", "Texas",
    ],
    "West": [
        "Arizona", "Colorado", "Idaho", "New Mexico", "Montana", "Utah", "Nevada",
        "Wyoming", "Alaska", "California", "Hawaii", "Oregon", "Washington",
    ],
}

# Category group -> substrings of the lower-cased label, first hit wins.
CATEGORY_GROUPS = [
    ("Tech", ["information technology", "software", " it ", "computer", "data ", "engineer", "cybersecurity"]),
    ("Healthcare", ["health", "medical", "nurse", "physician", "clinical", "dental"]),
    ("Finance", ["finance", "accounting", "budget", "audit", "fiscal"]),
    ("Legal", ["legal", "attorney", "law ", "judicial", "paralegal"]),
    ("HR", ["human resources", " hr ", "personnel"]),
    ("Operations", ["logistics", "supply chain", "procurement", "acquisition"]),
    ("Admin", ["admin", "clerical", "management analyst"]),
]

# Title words behind the experience level. 'sr.' is a regex with a
# wildcard: the word is followed by any one character.
ENTRY_WORDS_PRIVATE = r"intern|internship|entry[- ]level|junior|graduate|new grad|associate"
ENTRY_FLAG_WORDS_PRIVATE = r"intern|internship|entry[- ]level|junior|graduate|new grad"
SENIOR_WORDS_PRIVATE = r"senior|sr.|principal|staff|lead|director|head of|vp|chief"
ENTRY_WORDS_FEDERAL = r"intern|internship|entry[- ]level|junior|graduate|trainee"
SENIOR_WORDS_FEDERAL = r"senior|sr.|principal|staff|lead|director|chief|executive"

# Pay periods per year by rate code; other codes count as yearly.
PAY_PERIODS = {"PA": 1, "PH": 2080, "PB": 26}

# Yearly pay below / from which a federal posting is entry / senior.
FEDERAL_ENTRY_BELOW = 55000
FEDERAL_SENIOR_FROM = 100000

# Aggregation level range -> area type.
AREA_TYPE_RANGES = [
    (10, 19, "national"), (50, 59, "state"), (70, 79, "msa"),
    (30, 39, "county"), (90, 99, "csa"),
]

# Ownership code -> label.
OWNERSHIP_LABELS = {
    0: "Total", 1: "Federal", 2: "State", 3: "Local", 5: "Private", 8: "Total Private+Gov",
}

# Occupation group substrings, first hit wins.
OCCUPATION_GROUPS = ["major", "minor", "broad", "detailed"]

# Cells that mean "no value" in the two public files.
QCEW_NULL_TOKENS = ["", "NULL", "null"]
OEWS_NULL_TOKENS = ["", "*", "**", "#", "NULL"]

# File name prefixes of the occupational wage drops worth loading.
OEWS_FILE_PREFIXES = ["oesm", "MSA_M", "BOS_M", "natsector", "national_M", "all_data_M"]

# The code and title of a job title that no rule could place.
UNMAPPED_CODE = "99-9999"
UNMAPPED_TITLE = "Unmapped"
