"""Default specifications of the eight raw homeless-services tables.

The names and codes are those of the national data standard's CSV extracts. Types are given, so
reading needs no inference pass; columns not listed stay text.
"""

from __future__ import annotations

from .spec import TableSpec


# Column roles per table.
ENROLLMENT = TableSpec.from_dict(
    {
        "name": "enrollment",
        "person_enrollment_ID": "ProjectEntryID",
        "person_ID": "PersonalID",
        "program_ID": "ProjectID",
        "groupID_column": "HouseholdID",
        "duplicate_check_columns": ("ProjectEntryID", "PersonalID", "ProjectID", "HouseholdID"),
        "columns_to_drop": (
            "OtherResidencePrior", "TimesHomelessPastThreeYears", "MonthsHomelessPastThreeYears",
            "DateOfEngagement", "InPermanentHousing", "ResidentialMoveInDate", "DateOfPATHStatus",
            "ClientEnrolledInPATH", "ReasonNotEnrolled", "WorstHousingSituation", "PercentAMI",
            "AddressDataQuality", "DateOfBCPStatus", "FYSBYouth", "SexualOrientation",
            "FormerWardChildWelfare", "ChildWelfareYears", "ChildWelfareMonths",
            "FormerWardJuvenileJustice", "JuvenileJusticeYears", "JuvenileJusticeMonths",
            "IncarceratedParentStatus", "ReferralSource", "CountOutreachReferralApproaches",
            "ExchangeForSex", "ExchangeForSexPastThreeMonths", "CountOfExchangeForSex",
            "AskedOrForcedToExchangeForSex", "AskedOrForcedToExchangeForSexPastThreeMonths",
            "WorkPlaceViolenceThreats", "WorkplacePromiseDifference", "CoercedToContinueWork",
            "LaborExploitPastThreeMonths", "HPScreeningScore", "VAMCStation", "DateDeleted",
            "DisablingCondition", "EntryFromStreetESSH", "HouseholdDynamics",
            "SexualOrientationGenderIDYouth", "SexualOrientationGenderIDFam",
            "HousingIssuesYouth", "HousingIssuesFam", "SchoolEducationalIssuesYouth",
            "SchoolEducationalIssuesFam", "UnemploymentYouth", "UnemploymentFam",
            "MentalHealthIssuesYouth", "MentalHealthIssuesFam", "HealthIssuesYouth",
            "HealthIssuesFam", "PhysicalDisabilityYouth", "PhysicalDisabilityFam",
            "MentalDisabilityYouth", "MentalDisabilityFam", "AbuseAndNeglectYouth",
            "AbuseAndNeglectFam", "AlcoholDrugAbuseYouth", "AlcoholDrugAbuseFam",
            "InsufficientIncome", "ActiveMilitaryParent", "IncarceratedParent", "DateCreated",
            "DateUpdated", "UserID", "ExportID",
        ),
        "categorical_var": ("ResidencePrior", "ResidencePriorLengthOfStay"),
        "time_var": ("EntryDate", "DateToStreetESSH"),
        "entry_date": "EntryDate",
        "types": {
            **dict.fromkeys(("ResidencePrior", "ResidencePriorLengthOfStay"), "bigint"),
            **dict.fromkeys(("EntryDate", "DateToStreetESSH"), "date"),
        },
    }
)

EXIT = TableSpec.from_dict(
    {
        "name": "exit",
        "person_enrollment_ID": "ProjectEntryID",
        "destination_column": "Destination",
        "duplicate_check_columns": ("ProjectEntryID",),
        "columns_to_drop": (
            "ExitID", "PersonalID", "OtherDestination", "AssessmentDisposition",
            "OtherDisposition", "HousingAssessment", "SubsidyInformation", "ConnectionWithSOAR",
            "WrittenAftercarePlan", "AssistanceMainstreamBenefits", "PermanentHousingPlacement",
            "TemporaryShelterPlacement", "ExitCounseling", "FurtherFollowUpServices",
            "ScheduledFollowUpContacts", "ResourcePackage", "OtherAftercarePlanOrAction",
            "ProjectCompletionStatus", "EarlyExitReason", "FamilyReunificationAchieved",
            "DateCreated", "DateUpdated", "UserID", "DateDeleted", "ExportID",
        ),
        "categorical_var": ("Destination",),
        "time_var": ("ExitDate",),
        "types": {
            **dict.fromkeys(("Destination",), "bigint"),
            **dict.fromkeys(("ExitDate",), "date"),
        },
    }
)

CLIENT = TableSpec.from_dict(
    {
        "name": "client",
        "person_ID": "PersonalID",
        "duplicate_check_columns": (
            "PersonalID", "AmIndAKNative", "Asian", "BlackAfAmerican", "NativeHIOtherPacific",
            "White", "Ethnicity", "Gender", "VeteranStatus", "DOB",
        ),
        "columns_to_drop": (
            "RaceNone", "DateCreated", "DateUpdated", "UserID", "DateDeleted", "ExportID",
            "OtherGender",
        ),
        "categorical_var": (
            "AmIndAKNative", "Asian", "BlackAfAmerican", "NativeHIOtherPacific", "White",
            "Ethnicity", "Gender", "VeteranStatus", "WorldWarII", "KoreanWar", "VietnamWar",
            "DesertStorm", "AfghanistanOEF", "IraqOIF", "IraqOND", "OtherTheater",
            "MilitaryBranch", "DischargeStatus",
        ),
        "time_var": ("DOB", "YearEnteredService", "YearSeparated"),
        "dob_column": "DOB",
        "boolean": (
            "AmIndAKNative", "Asian", "BlackAfAmerican", "NativeHIOtherPacific", "White",
            "Ethnicity", "VeteranStatus", "WorldWarII", "KoreanWar", "VietnamWar", "DesertStorm",
            "AfghanistanOEF", "IraqOIF", "IraqOND", "OtherTheater",
        ),
        "numeric_code": ("Gender", "MilitaryBranch", "DischargeStatus"),
        "name_columns": ("FirstName", "LastName"),
        "types": {
            **dict.fromkeys((
                "AmIndAKNative", "Asian", "BlackAfAmerican", "NativeHIOtherPacific", "White",
                "Ethnicity", "Gender", "VeteranStatus", "WorldWarII", "KoreanWar", "VietnamWar",
                "DesertStorm", "AfghanistanOEF", "IraqOIF", "IraqOND", "OtherTheater",
                "MilitaryBranch", "DischargeStatus",
            ), "bigint"),
            **dict.fromkeys(("DOB", "YearEnteredService", "YearSeparated"), "date"),
        },
    }
)

DISABILITIES = TableSpec.from_dict(
    {
        "name": "disabilities",
        "person_enrollment_ID": "ProjectEntryID",
        "duplicate_check_columns": (
            "ProjectEntryID", "DataCollectionStage", "DisabilityType", "DisabilityResponse",
        ),
        "columns_to_drop": (
            "DisabilitiesID", "PersonalID", "InformationDate", "IndefiniteAndImpairs",
            "ReceivingServices", "DocumentationOnFile", "PATHHowConfirmed", "PATHSMIInformation",
            "DateCreated", "DateUpdated", "UserID", "DateDeleted", "ExportID", "TCellSource",
            "ViralLoadAvailable", "ViralLoad", "ViralLoadSource", "TCellCountAvailable",
            "TCellCount",
        ),
        "categorical_var": ("DisabilityResponse",),
        "collection_stage_column": "DataCollectionStage",
        "entry_stage_val": 1,
        "exit_stage_val": 3,
        "update_stage_val": 2,
        "annual_assessment_stage_val": 5,
        "post_exit_stage_val": 6,
        "type_column": "DisabilityType",
        "response_column": "DisabilityResponse",
        "types": {
            **dict.fromkeys(("DisabilityResponse", "DataCollectionStage", "DisabilityType"), "bigint"),
        },
    }
)

EMPLOYMENT_EDUCATION = TableSpec.from_dict(
    {
        "name": "employment_education",
        "person_enrollment_ID": "ProjectEntryID",
        "duplicate_check_columns": ("ProjectEntryID", "Employed", "DataCollectionStage"),
        "columns_to_drop": (
            "EmploymentEducationID", "PersonalID", "InformationDate", "LastGradeCompleted",
            "SchoolStatus", "EmploymentType", "NotEmployedReason", "DateCreated", "DateUpdated",
            "UserID", "DateDeleted", "ExportID",
        ),
        "categorical_var": ("Employed",),
        "collection_stage_column": "DataCollectionStage",
        "entry_stage_val": 1,
        "exit_stage_val": 3,
        "update_stage_val": 2,
        "annual_assessment_stage_val": 5,
        "post_exit_stage_val": 6,
        "types": {
            **dict.fromkeys(("Employed", "DataCollectionStage"), "bigint"),
        },
    }
)

HEALTH_DV = TableSpec.from_dict(
    {
        "name": "health_dv",
        "person_enrollment_ID": "ProjectEntryID",
        "duplicate_check_columns": (
            "ProjectEntryID", "DomesticViolenceVictim", "GeneralHealthStatus", "PregnancyStatus",
            "DataCollectionStage",
        ),
        "columns_to_drop": (
            "HealthAndDVID", "PersonalID", "InformationDate", "WhenOccurred",
            "DentalHealthStatus", "MentalHealthStatus", "DueDate", "DateCreated", "DateUpdated",
            "UserID", "DateDeleted", "ExportID",
        ),
        "categorical_var": ("DomesticViolenceVictim", "GeneralHealthStatus", "PregnancyStatus"),
        "collection_stage_column": "DataCollectionStage",
        "entry_stage_val": 1,
        "exit_stage_val": 3,
        "update_stage_val": 2,
        "annual_assessment_stage_val": 5,
        "post_exit_stage_val": 6,
        "types": {
            **dict.fromkeys((
                "DomesticViolenceVictim", "GeneralHealthStatus", "PregnancyStatus",
                "DataCollectionStage",
            ), "bigint"),
        },
    }
)

INCOME = TableSpec.from_dict(
    {
        "name": "income",
        "person_enrollment_ID": "ProjectEntryID",
        "duplicate_check_columns": (
            "ProjectEntryID", "IncomeFromAnySource", "TotalMonthlyIncome", "Earned",
            "EarnedAmount", "TANF", "TANFAmount", "GA", "GAAmount", "ChildSupport",
            "ChildSupportAmount", "BenefitsFromAnySource", "SNAP", "WIC", "TANFChildCare",
            "RentalAssistanceOngoing", "RentalAssistanceTemp", "InsuranceFromAnySource",
            "Medicaid", "Medicare", "SCHIP", "DataCollectionStage",
        ),
        "columns_to_drop": (
            "IncomeBenefitsID", "PersonalID", "InformationDate", "Unemployment",
            "UnemploymentAmount", "SSI", "SSIAmount", "SSDI", "SSDIAmount", "VADisabilityService",
            "VADisabilityServiceAmount", "VADisabilityNonService", "VADisabilityNonServiceAmount",
            "PrivateDisability", "PrivateDisabilityAmount", "WorkersComp", "WorkersCompAmount",
            "SocSecRetirement", "SocSecRetirementAmount", "Pension", "PensionAmount", "Alimony",
            "AlimonyAmount", "OtherIncomeSource", "OtherIncomeAmount",
            "OtherIncomeSourceIdentify", "TANFTransportation", "OtherTANF", "OtherBenefitsSource",
            "OtherBenefitsSourceIdentify", "NoMedicaidReason", "NoMedicareReason",
            "NoSCHIPReason", "VAMedicalServices", "NoVAMedReason", "EmployerProvided",
            "NoEmployerProvidedReason", "COBRA", "NoCOBRAReason", "PrivatePay",
            "NoPrivatePayReason", "StateHealthIns", "NoStateHealthInsReason", "HIVAIDSAssistance",
            "NoHIVAIDSAssistanceReason", "ADAP", "NoADAPReason", "DateCreated", "DateUpdated",
            "UserID", "DateDeleted", "ExportID",
        ),
        "categorical_var": (
            "IncomeFromAnySource", "Earned", "TANF", "GA", "ChildSupport",
            "BenefitsFromAnySource", "SNAP", "WIC", "TANFChildCare", "RentalAssistanceOngoing",
            "RentalAssistanceTemp", "InsuranceFromAnySource", "Medicaid", "Medicare", "SCHIP",
        ),
        "collection_stage_column": "DataCollectionStage",
        "entry_stage_val": 1,
        "exit_stage_val": 3,
        "update_stage_val": 2,
        "annual_assessment_stage_val": 5,
        "post_exit_stage_val": 6,
        "columns_to_take_max": (
            "IncomeFromAnySource", "TotalMonthlyIncome", "Earned", "EarnedAmount", "TANF",
            "TANFAmount", "GA", "GAAmount", "ChildSupport", "ChildSupportAmount",
            "BenefitsFromAnySource", "SNAP", "WIC", "TANFChildCare", "RentalAssistanceOngoing",
            "RentalAssistanceTemp", "InsuranceFromAnySource", "Medicaid", "Medicare", "SCHIP",
        ),
        "types": {
            **dict.fromkeys((
                "IncomeFromAnySource", "Earned", "TANF", "GA", "ChildSupport",
                "BenefitsFromAnySource", "SNAP", "WIC", "TANFChildCare",
                "RentalAssistanceOngoing", "RentalAssistanceTemp", "InsuranceFromAnySource",
                "Medicaid", "Medicare", "SCHIP", "DataCollectionStage",
            ), "bigint"),
            **dict.fromkeys((
                "TotalMonthlyIncome", "EarnedAmount", "TANFAmount", "GAAmount",
                "ChildSupportAmount",
            ), "double"),
        },
    }
)

PROJECT = TableSpec.from_dict(
    {
        "name": "project",
        "program_ID": "ProjectID",
        "duplicate_check_columns": ("ProjectID", "OrganizationID", "ProjectName", "ProjectType"),
        "columns_to_drop": (
            "ContinuumProject", "ResidentialAffiliation", "TrackingMethod", "TargetPopulation",
            "DateCreated", "DateUpdated", "UserID", "DateDeleted", "ExportID",
        ),
        "project_type_column": "ProjectType",
        "types": {
            **dict.fromkeys(("ProjectType",), "bigint"),
        },
    }
)

DEFAULT_SPECS = {
    "enrollment": ENROLLMENT,
    "exit": EXIT,
    "client": CLIENT,
    "disabilities": DISABILITIES,
    "employment_education": EMPLOYMENT_EDUCATION,
    "health_dv": HEALTH_DV,
    "income": INCOME,
    "project": PROJECT,
}

# Default file name of every table.
DEFAULT_FILES = {
    "enrollment": "Enrollment.csv",
    "exit": "Exit.csv",
    "client": "Client.csv",
    "disabilities": "Disabilities.csv",
    "employment_education": "EmploymentEducation.csv",
    "health_dv": "HealthAndDV.csv",
    "income": "IncomeBenefits.csv",
    "project": "Project.csv",
}
