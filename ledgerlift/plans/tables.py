"""Schemas of the registry tables, as DDL, and how child tables hang together."""

AUDIT = "created_at timestamp, updated_at timestamp, created_by string"

APPLICATIONS = (
    "id string, application_number string, application_type string, approval_no string, approval_date date, "
    "status string, username string, old_created_by string, is_migrated boolean, effective_date date, expire_date date, "
    "intimate_date date, months_eligible bigint, licence_path string, completed_at timestamp, category_id string, certificate_id string, license_type string, "
    "category_license_type string, zone_id string, zone_name string, old_parent_application_id string, " + AUDIT
)
CERTIFICATES = (
    "id string, application_id string, application_number string, approval_no string, approval_date date, "
    "application_certificate_type string, effective_date date, expire_date date, intimate_date date, months_eligible bigint, "
    "licence_path string, license_type string, category_license_type string, certificate_owner string, owner_id string, zone_id string, zone_name string, "
    "sector string, certificate_type string, " + AUDIT
)
ADDRESS = (
    "region",
    "district",
    "ward",
    "street",
    "road",
    "plot_no",
    "address_code",
    "address_no",
    "block_no",
)
BUSINESS = (
    "mobile_no",
    "email",
    "website",
    "latitude",
    "longitude",
    "po_box",
    "facility_name",
    "company_name",
    "tin",
    "tin_name",
    "brela_number",
    "brela_registration_type",
    "certificate_of_incorporation_no",
)
SECTOR_DETAILS = (
    "id string, application_id string, applicant_legal_status_id string, "
    + ", ".join(f"{c} string" for c in ADDRESS + BUSINESS)
    + ", vrn string, gn_gazette_on string, government_notice_no string, "
    + AUDIT
)
DOCUMENTS = (
    "id string, application_id string, application_sector_detail_id string, document_name string, file_name string, "
    "document_url string, documents_order int, logic_doc_id bigint, " + AUDIT
)
CONTACT_PERSONS = (
    "id string, application_id string, app_sector_detail_id string, contact_name string, email string, mobile_no string, "
    "title string, " + AUDIT
)
FIRE_FIELDS = (
    "fire_certificate_control_number",
    "premise_name",
    "region",
    "district",
    "ward",
    "administrative_area",
    "street",
    "valid_from",
    "valid_to",
)
FIRE = "id string, application_id string, application_sector_detail_id string, " + ", ".join(
    f"{c} string" for c in FIRE_FIELDS
) + ", " + AUDIT
COVER_FIELDS = (
    "cover_note_number",
    "cover_note_ref_no",
    "cover_note_start_date",
    "cover_note_end_date",
    "insurance_ref_no",
    "insurer_company_name",
    "policy_holder_name",
    "risk_name",
    "subject_matter_desc",
)
INSURANCE = "id string, application_id string, application_sector_detail_id string, " + ", ".join(
    f"{c} string" for c in COVER_FIELDS
) + ", " + AUDIT
SHAREHOLDERS = (
    "id string, application_id string, application_sector_detail_id string, shareholder_name string, first_name string, "
    "middle_name string, last_name string, amount_of_share_percent decimal(38,6), country_of_residence string, "
    "country_of_incorporation string, nationality string, individual_company string, street_address string, "
    "file_name string, logic_doc_id bigint, " + AUDIT
)
DIRECTORS = (
    "id string, application_id string, application_sector_detail_id string, name string, first_name string, "
    "middle_name string, last_name string, email string, mobile_no string, country string, nationality string, "
    "work_permit bigint, work_permit_filename string, cpana bigint, cpana_filename string, " + AUDIT
)
INSTALLATIONS = (
    "id string, application_id string, applicant_name string, experience_type string, approved_class_id string, "
    "is_migrated boolean, " + AUDIT
)
_INSTALLATION_CHILD = "id string, application_id string, application_electrical_installation_id string, "
CONTACT_DETAILS = _INSTALLATION_CHILD + (
    "region string, district string, ward string, email string, mobile_no string, plot_no string, po_box string, " + AUDIT
)
PERSONAL_DETAILS = _INSTALLATION_CHILD + (
    "date_of_birth date, nationality string, gender string, work_permit_no string, " + AUDIT
)
ATTACHMENTS = _INSTALLATION_CHILD + (
    "identification string, identification_name string, passport string, passport_name string, " + AUDIT
)
SELF_EMPLOYED = _INSTALLATION_CHILD + (
    "from_date timestamp, to_date timestamp, project_performed string, voltage_level string, voltage string, " + AUDIT
)
CUSTOM_DETAILS = "id string, application_id string, self_employed_details_id string, name string, mobile_no string, " + AUDIT
WORK_EXPERIENCE = _INSTALLATION_CHILD + (
    "from_date timestamp, to_date timestamp, work_description string, voltage_level string, voltage string, "
    "name_of_employer string, position string, role string, " + AUDIT
)
SUPERVISOR_DETAILS = _INSTALLATION_CHILD + (
    "work_experience_id string, name string, position string, email string, mobile_no string, " + AUDIT
)
VERIFICATIONS = _INSTALLATION_CHILD + (
    "from_date timestamp, to_date timestamp, education_regulatory_body string, "
    "education_regulatory_body_category string, logic_doc_id bigint, file_name string, " + AUDIT
)
_DETAIL_CHILD = "id string, application_id string, application_sector_detail_id string, "
REFEREES = _DETAIL_CHILD + "telephone_no string, title string, contact_person_name string, " + AUDIT
BANK_DETAILS = _DETAIL_CHILD + (
    "name_of_banker string, position string, contact_person_name string, telephone_no string, email string, "
    "po_box string, " + AUDIT
)
FINANCIAL = _DETAIL_CHILD + (
    "bank_details_tz_id string, referee_id string, fs string, amount string, currency string, " + AUDIT
)
INVESTMENT = _DETAIL_CHILD + "amount string, currency string, " + AUDIT
PROJECT = _DETAIL_CHILD + "number_of_customer string, " + AUDIT

SECTORS = "id string, name string"
CATEGORIES = (
    "id string, name string, code string, sector_id string, sub_sector_type string, category_type string, "
    "is_approved boolean, has_fee_range boolean, apply_thereof boolean, thereof_factor int, thereof_price decimal(11,2), "
    "capacity_unit string, voltage_level string, fees_category_id string, deleted_at timestamp, "
    "created_at timestamp, updated_at timestamp"
)
FEES = (
    "id string, category_id string, status string, license_type string, category_license_type string, "
    "application_type string, no_customer_from string, no_customer_to string, capacity_from decimal(38,6), "
    "capacity_to string, application_fee decimal(38,6), license_fee decimal(38,6), annual_fee decimal(38,6), "
    "application_prefix string, license_prefix string, months_eligible bigint, sector_type string, "
    "deleted_at timestamp, created_at timestamp, updated_at timestamp"
)
USERS = (
    "id string, full_name string, username string, password_hash string, status string, phone_number string, "
    "email_address string, user_category string, account_type string, auth_mode string, failed_attempts int, "
    "is_first_login boolean, deleted boolean, created_at timestamp, updated_at timestamp"
)
ROLES = "id string, name string, deleted boolean, active boolean, created_at timestamp, updated_at timestamp"
USER_ROLES = "user_id string, role_id string"
LEGAL_STATUS = "id string, name string, deleted_at timestamp"

#: table -> (foreign key, parent key) for application_id through sector details
DETAIL_CHILDREN = {
    "documents": ("application_sector_detail_id", "id"),
    "contact_persons": ("app_sector_detail_id", "id"),
    "fire": ("application_sector_detail_id", "id"),
    "insurance_cover_details": ("application_sector_detail_id", "id"),
    "shareholders": ("application_sector_detail_id", "id"),
    "managing_directors": ("application_sector_detail_id", "id"),
    "ardhi_information": ("application_sector_detail_id", "id"),
}
#: the same through the electrical installation
INSTALLATION_CHILDREN = {
    name: ("application_electrical_installation_id", "id")
    for name in (
        "personal_details",
        "contact_details",
        "attachments",
        "work_experience",
        "self_employed",
        "supervisor_details",
        "costumer_details",
        "certificate_verifications",
    )
}
#: tables whose created_by follows the user of their application
OWNED_BY_USER = (
    "certificates",
    "application_sector_details",
    "application_electrical_installation",
    "task_assignments",
    *DETAIL_CHILDREN,
    *INSTALLATION_CHILDREN,
    "referees",
    "bank_details_tanzania",
    "financial_information",
    "applicant_proposed_investment",
    "project_description",
)
