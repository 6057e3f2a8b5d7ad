"""Prevailing-wage releases: the target schema is the newest file's header, every
target maps to itself, and these headers are renamed."""

from __future__ import annotations

# Release header -> newest header.
WAGE_RENAMES = {
    "ADDITIONAL_WORKSITE_LOCATIONS": "OTHER_WORKSITE_LOCATION",
    "BUSINESS_NAME": "EMPLOYER_LEGAL_BUSINESS_NAME",
    "DETERMINATION_ISSUED": "DETERMINATION_DATE",
    "EIN": "EMPLOYER_FEIN",
    "EMPLOYER_ADDFRESS_1": "EMPLOYER_ADDRESS_1",
    "EMP_EXPERIENCE_MONTHS": "ALT_EXPERIENCE_MONTHS",
    "EMP_EXPERIENCE_REQD": "REQUIRED_EXPERIENCE",
    "EMP_EXPERIENCE_REQUIRED": "REQUIRED_EXPERIENCE",
    "MAJOR": "REQUIRED_EDUCATION_MAJOR",
    "NAME_REQD_TRAINING": "REQUIRED_TRAINING",
    "NAME_REQUIRED_TRAINING": "REQUIRED_TRAINING",
    "NUMBER_OF_MONTHS_TRAINING": "REQUIRED_TRAINING_MONTHS",
    "NUM_MONTHS_TRAINING": "REQUIRED_TRAINING_MONTHS",
    "OCCUPATION_REQUIRED": "REQUIRED_OCCUPATION",
    "OTHER_EDUCATION": "REQUIRED_OTHER_DEGREE",
    "PRIMARY_EDUCATION_LEVEL": "REQUIRED_EDUCATION_LEVEL",
    "PWD_SOC_CODE_TITLE": "PWD_SOC_TITLE",
    "PWD_WAGE_LEVEL": "PWD_OES_WAGE_LEVEL",
    "PW_JOB_TITLE": "JOB_TITLE",
    "PW_SOC_TITLE": "PWD_SOC_TITLE",
    "PW_UNIT_OF_PAY": "PWD_UNIT_OF_PAY",
    "PW_WITHDRAWAL_DATE": "WITHDRAWAL_DATE",
    "REDTERMINATION_DATE": "REDETERMINATION_DATE",
    "REQUESTED_WAGE_SOURCE": "WAGE_SOURCE_REQUESTED",
    "REQUESTOR_POC_ADDRESS1": "EMPLOYER_POC_ADDRESS1",
    "REQUESTOR_POC_ADDRESS2": "EMPLOYER_POC_ADDRESS2",
    "REQUESTOR_POC_CITY": "EMPLOYER_POC_CITY",
    "REQUESTOR_POC_COUNTRY": "EMPLOYER_POC_COUNTRY",
    "REQUESTOR_POC_EMAIL": "EMPLOYER_POC_EMAIL",
    "REQUESTOR_POC_FIRST_NAME": "EMPLOYER_POC_FIRST_NAME",
    "REQUESTOR_POC_JOB_TITLE": "EMPLOYER_POC_JOB_TITLE",
    "REQUESTOR_POC_LAST_NAME": "EMPLOYER_POC_LAST_NAME",
    "REQUESTOR_POC_MIDDLE_NAME": "EMPLOYER_POC_MIDDLE_NAME",
    "REQUESTOR_POC_PHONE": "EMPLOYER_POC_PHONE",
    "REQUESTOR_POC_PHONE_EXT": "EMPLOYER_POC_PHONE_EXT",
    "REQUESTOR_POC_POSTAL_CODE": "EMPLOYER_POC_POSTAL_CODE",
    "REQUESTOR_POC_PROVINCE": "EMPLOYER_POC_PROVINCE",
    "REQUESTOR_POC_STATE": "EMPLOYER_POC_STATE",
    "SECOND_DIPLOMA": "SECOND_EDUCATION",
    "SECOND_DIPLOMA_MAJOR": "SECOND_EDUCATION_MAJOR",
    "SPECIAL_REQUIREMENTS": "SPECIAL_SKILLS_REQUIREMENTS",
    "STATUS": "CASE_STATUS",
    "SUBMIT_DATE": "RECEIVED_DATE",
    "TRADE_NAME": "TRADE_NAME_DBA",
}

# Headers of one vintage that are neither mapped nor reported.
IGNORED_HEADERS = {
    2015: [
        "CASE_ASSIGNED_TO_ANALYST",
        "CASE_SENT_TO_CO_FOR_APPROVAL",
        "DATE_REDETERMINATION_RECEIVED",
        "VOIDED_DATE",
        "PW_TRACKING_NUMBER",
        "TYPE_DBA_SCA",
    ],
}
