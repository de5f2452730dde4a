"""Benefit category labels used when benefit documents are exported.

Fixed values: these defaults must equal the published category names for the
exported documents to match; dictionary labels for the year are merged over
them (``benefits.category_labels``). Listed in their natural order.
"""

# ---------------------------------------------------------------------------
# Benefit category code -> label (defaults)
# ---------------------------------------------------------------------------
DEFAULT_CATEGORY_LABELS = {
    "1a": "Inpatient Hospital - Acute",
    "1a1": "Inpatient Hospital - Acute",
    "1a2": "Inpatient Hospital - Acute",
    "1a3": "Inpatient Hospital - Acute",
    "1b": "Inpatient Hospital Psychiatric",
    "1b1": "Inpatient Hospital Psychiatric",
    "1b2": "Inpatient Hospital Psychiatric",
    "2": "Skilled Nursing Facility (SNF)",
    "2-1": "Skilled Nursing Facility (SNF)",
    "3": "Cardiac and Pulmonary Rehabilitation Services",
    "3-1": "Cardiac and Pulmonary Rehabilitation Services",
    "3-2": "Cardiac and Pulmonary Rehabilitation Services",
    "3-3": "Cardiac and Pulmonary Rehabilitation Services",
    "3-4": "Cardiac and Pulmonary Rehabilitation Services",
    "4a": "Emergency/Post-Stabilization Services",
    "4b": "Urgently Needed Services",
    "4c": "Worldwide Emergency/Urgent Coverage",
    "5": "Partial Hospitalization",
    "6": "Home Health Services",
    "7a": "Primary Care Physician Services",
    "7b": "Chiropractic Services",
    "7c": "Occupational Therapy Services",
    "7d": "Physician Specialist Services Excluding Psychiatric Services",
    "7e": "Mental Health Specialty Services (Non-Physician)",
    "7f": "Podiatry Services",
    "7g": "Other Health Care Professional Services",
    "7h": "Psychiatric Services",
    "7i": "Physical Therapy and Speech-Language Pathology Services",
    "7j": "Additional Telehealth Benefits",
    "7k": "Opioid Treatment Program Services",
    "8a": "Outpatient Diagnostic Procedures/Tests/Lab Services",
    "8a1": "Outpatient Diagnostic Procedures/Tests/Lab Services",
    "8a2": "Outpatient Diagnostic Procedures/Tests/Lab Services",
    "8b": "Outpatient Diagnostic/Therapeutic Radiological Services",
    "8b1": "Outpatient Diagnostic/Therapeutic Radiological Services",
    "8b2": "Outpatient Diagnostic/Therapeutic Radiological Services",
    "8b3": "Outpatient Diagnostic/Therapeutic Radiological Services",
    "9a": "Outpatient Hospital Services",
    "9a1": "Outpatient Hospital Services",
    "9a2": "Outpatient Hospital Services",
    "9b": "Ambulatory Surgical Center (ASC) Services",
    "9c": "Outpatient Substance Abuse Services",
    "9c1": "Outpatient Substance Abuse Services",
    "9c2": "Outpatient Substance Abuse Services",
    "9d": "Outpatient Blood Services",
    "10a": "Ambulance Services",
    "10a1": "Ambulance Services",
    "10a2": "Ambulance Services",
    "10b": "Transportation Services",
    "11a": "Durable Medical Equipment (DME)",
    "11b": "Prosthetics/Medical Supplies",
    "11b1": "Prosthetics/Medical Supplies",
    "11b2": "Prosthetics/Medical Supplies",
    "11c": "Diabetic Supplies and Services",
    "11c1": "Diabetic Supplies and Services",
    "11c2": "Diabetic Supplies and Services",
    "12": "Dialysis Services",
    "13a": "Acupuncture (non-Medicare covered)",
    "13b": "OTC Items",
    "13c": "Meal Benefit",
    "13d": "Other 1",
    "13e": "Other 2",
    "13f": "Other 3",
    "13g": "Dual Eligible SNPs with Highly Integrated Services",
    "13h": "Additional Services",
    "14a": "Medicare-covered Zero Dollar Preventive Services",
    "14b": "Annual Physical Exam",
    "14c": "Other Defined Supplemental Benefits",
    "14d": "Kidney Disease Education Services",
    "14e": "Other Medicare-covered Preventive Services",
    "14e1": "Other Medicare-covered Preventive Services",
    "14e2": "Other Medicare-covered Preventive Services",
    "14e3": "Other Medicare-covered Preventive Services",
    "14e4": "Other Medicare-covered Preventive Services",
    "14e5": "Other Medicare-covered Preventive Services",
    "15": "Medicare Part B Rx Drugs",
    "15-1": "Medicare Part B Rx Drugs",
    "15-2": "Medicare Part B Rx Drugs",
    "15-3": "Medicare Part B Rx Drugs",
    "16a": "Medicare-covered dental",
    "16b": "Diagnostic & Preventive dental",
    "16c": "Comprehensive dental",
    "17a": "Eye Exams",
    "17b": "Eye Wear",
    "18a": "Hearing Exams",
    "18b": "Prescription Hearing Aids",
    "18c": "OTC Hearing Aids",
    "V/T": "Visitor/Travel",
    "19a": "Reduced Cost Sharing for VBID/MA Uniformity/SSBCI",
    "19b": "Additional Benefits for VBID/Uniformity/SSBCI",
    "19c": "VBID Hospice",
    "Com.Ben.": "Combined Benefits",
    "RICS": "Reductions in Cost Sharing"
}
