"""Rule tables. All values here are fixed values that results depend on."""

from __future__ import annotations

REGISTRY_STATUS = {"OPEN TO ACCRUAL": "open to accrual", "CLOSED TO ACCRUAL": "closed to accrual", "SUSPENDED": "suspended", "COMPLETED": "closed to accrual"}
STUDY_STATUS = {
    "RECRUITING": "open to accrual",
    "NOT_YET_RECRUITING": "open to accrual",
    "ENROLLING_BY_INVITATION": "open to accrual",
    "ACTIVE_NOT_RECRUITING": "closed to accrual",
    "COMPLETED": "closed to accrual",
    "TERMINATED": "closed to accrual",
    "WITHDRAWN": "closed to accrual",
    "SUSPENDED": "suspended",
    "UNKNOWN": "open to accrual",
}
PHASES = {"EARLY_PHASE1": "Early Phase I", "PHASE1": "Phase I", "PHASE2": "Phase II", "PHASE3": "Phase III", "PHASE4": "Phase IV"}
OTHER_PHASES = {"NA": "N/A"}
PHASE_AS_IS = ("N/A", "UNSPECIFIED", "OTHER")
AGE_GROUP = {"adults": "Adult", "children": "Pediatric", "both": "Both", "unspecified": "Both"}
AGE_SETS = {"CHILD": "Pediatric", "ADULT": "Adult", "OLDER_ADULT": "Adult", "ADULT+OLDER_ADULT": "Adult", "ADULT+CHILD": "Both", "ADULT+CHILD+OLDER_ADULT": "Both"}
AGE_PREDICATE = {"adults": ">=18", "children": "<18"}
TRIAL_GENDER = {"ALL": "All", "MALE": "Male", "FEMALE": "Female"}
PATIENT_GENDER = {"male": "Male", "female": "Female", "m": "Male", "f": "Female"}

#: variant type: category (None: known, but without genomic row)
VARIANT_CATEGORY = {
    "SNV": "MUTATION",
    "INDEL": "MUTATION",
    "fusion": "SV",
    "cnv": "CNV",
    "pertinent_negative": "MUTATION",
    "tumor_biomarker": "SIGNATURE",
    "germline": "MUTATION",
    "hla": None,
    "indeterminate": None,
    "mutation": "MUTATION",
    "somatic_mutation": "MUTATION",
    "amplification": "CNV",
    "deletion": "MUTATION",
    "structural_variant": "SV",
    "tumor biomarker": "SIGNATURE",
    "negative": "MUTATION",
    "expression": None,
    "immunotherapy_marker": None,
    "": None,
    "na": None,
    "NA": None,
}
WILDTYPE = ("pertinent_negative", "negative")
FUSION = ("fusion", "structural_variant")
BIOMARKER = ("tumor_biomarker", "tumor biomarker")
CNV_CALL = {"amplification": "High level amplification", "deletion": "Heterozygous deletion"}
TMB_GENES = ("TMB", "TUMOR MUTATIONAL BURDEN")
MMR_GENES = ("MMR", "MSI", "MICROSATELLITE INSTABILITY", "MISMATCH REPAIR", "MLH1", "MSH2", "MSH6", "MSH5", "PMS2")
POLE_GENES, APOBEC_GENES, TOBACCO_GENES = ("POLE",), ("APOBEC",), ("TOBACCO", "SMOKING")
MMR_DEFICIENT, MMR_PROFICIENT = ("deficient", "dmmr", "msi-h", "msi-high", "loss"), ("proficient", "pmmr", "mss", "intact", "stable")
MMR_LABELS = ("Deficient (MMR-D / MSI-H)", "Proficient (MMR-P / MSS)")

PATIENT_HEADER = {"first_name": "First Name", "last_name": "Last Name", "dob": "Date of Birth", "vital_status": "Vital Status", "oncotree_primary_diagnosis": "Diagnosis (OncoTree)"}
PATIENT_DETAIL = {"primary_dx": "Primary Diagnosis", "metastasis_sites": "Metastasis Sites", "mrn": "MRN", "sex": "Gender", "entity": "Institution"}
GENOMIC_MATCH = {"true_hugo_symbol": "Gene", "true_protein_change": "Protein Change", "true_cdna_change": "cDNA Change", "variant_category": "Variant Category", "genomic_alteration": "Alteration"}
MATCH_ENGINE = "MatchMiner-v2"

#: site, group, subgroup ("" stands for any): diagnosis; None: a rule that gives no diagnosis
CATEGORY_DIAGNOSIS = {
    ("Breast", "", ""): "Breast",
    ("Breast", "Her2 Positive", ""): "Breast",
    ("Breast", "Triple Negative", ""): "Breast",
    ("Breast", "Hormone Receptor Positive", ""): "Breast",
    ("Thoracic", "Non-small cell lung cancer", "Stage I-III (Resectable)"): "Non-Small Cell Lung Cancer",
    ("Thoracic", "Non-small cell lung cancer", "Stage IV"): "Non-Small Cell Lung Cancer",
    ("Thoracic", "Non-small cell lung cancer", ""): "Non-Small Cell Lung Cancer",
    ("Thoracic", "Small cell lung cancer", "All"): "Small Cell Lung Cancer",
    ("Thoracic", "Small cell lung cancer", ""): "Small Cell Lung Cancer",
    ("Thoracic", "", ""): "Lung",
    ("Gastrointestinal", "Colorectal", "Advanced"): "Colorectal Adenocarcinoma",
    ("Gastrointestinal", "Colorectal", "Localized"): "Colorectal Adenocarcinoma",
    ("Gastrointestinal", "Colorectal", ""): "Colorectal Adenocarcinoma",
    ("Gastrointestinal", "Pancreatic", "Advanced"): "Pancreatic Adenocarcinoma",
    ("Gastrointestinal", "Pancreatic", "Localized"): "Pancreatic Adenocarcinoma",
    ("Gastrointestinal", "Pancreatic", ""): "Pancreatic Adenocarcinoma",
    ("Gastrointestinal", "Hepatocellular", "Advanced"): "Hepatocellular Carcinoma",
    ("Gastrointestinal", "Hepatocellular", "Localized"): "Hepatocellular Carcinoma",
    ("Gastrointestinal", "Hepatocellular", ""): "Hepatocellular Carcinoma",
    ("Gastrointestinal", "Gastroesophageal", "Advanced"): "Esophagogastric Adenocarcinoma",
    ("Gastrointestinal", "Gastroesophageal", ""): "Esophagogastric Adenocarcinoma",
    ("Gastrointestinal", "Biliary", "Advanced"): "Biliary Tract",
    ("Gastrointestinal", "Neuroendocrine", "Advanced"): "Gastrointestinal Neuroendocrine Tumors",
    ("Gastrointestinal", "Neuroendocrine", "Localized"): "Gastrointestinal Neuroendocrine Tumors",
    ("Gastrointestinal", "Neuroendocrine", ""): "Gastrointestinal Neuroendocrine Tumors",
    ("Gastrointestinal", "", ""): None,
    ("Genitourinary", "Prostate", "Localized / Curative"): "Prostate Adenocarcinoma",
    ("Genitourinary", "Prostate", "Metastatic Castration Resistant"): "Prostate Adenocarcinoma",
    ("Genitourinary", "Prostate", "Biochemically Recurrent / Salvage (post-surgery with returned PSA)"): "Prostate Adenocarcinoma",
    ("Genitourinary", "Prostate", ""): "Prostate Adenocarcinoma",
    ("Genitourinary", "Bladder", "Metastatic"): "Bladder Urothelial Carcinoma",
    ("Genitourinary", "Bladder", "Muscle Invasive / Perioperative"): "Bladder Urothelial Carcinoma",
    ("Genitourinary", "Bladder", ""): "Bladder Urothelial Carcinoma",
    ("Genitourinary", "Renal", "Metastatic"): "Renal Cell Carcinoma",
    ("Genitourinary", "", ""): None,
    ("Gynecologic", "Treatment", "Ovary"): "Ovarian Epithelial Tumor",
    ("Gynecologic", "Treatment", "Endometrial"): "Endometrial Carcinoma",
    ("Gynecologic", "Treatment", ""): None,
    ("Gynecologic", "", ""): None,
    ("Head, Neck and Endocrine", "Locally Advanced Head and Neck", "Laryngeal"): "Head and Neck Squamous Cell Carcinoma",
    ("Head, Neck and Endocrine", "Locally Advanced Head and Neck", "Nasopharyngeal"): "Head and Neck Squamous Cell Carcinoma",
    ("Head, Neck and Endocrine", "Locally Advanced Head and Neck", "Oral Cavity"): "Head and Neck Squamous Cell Carcinoma",
    ("Head, Neck and Endocrine", "Locally Advanced Head and Neck", "Oropharyngeal"): "Head and Neck Squamous Cell Carcinoma",
    ("Head, Neck and Endocrine", "Locally Advanced Head and Neck", "Other Sites"): "Head and Neck Squamous Cell Carcinoma",
    ("Head, Neck and Endocrine", "Locally Advanced Head and Neck", ""): "Head and Neck Squamous Cell Carcinoma",
    ("Head, Neck and Endocrine", "Recurrent/Metastatic Head and Neck", "EBV+ Nasopharyngeal"): "Head and Neck Squamous Cell Carcinoma",
    ("Head, Neck and Endocrine", "Recurrent/Metastatic Head and Neck", "HPV+ Oropharyngeal"): "Head and Neck Squamous Cell Carcinoma",
    ("Head, Neck and Endocrine", "Recurrent/Metastatic Head and Neck", "Other Sites"): "Head and Neck Squamous Cell Carcinoma",
    ("Head, Neck and Endocrine", "Recurrent/Metastatic Head and Neck", ""): "Head and Neck Squamous Cell Carcinoma",
    ("Head, Neck and Endocrine", "Cutaneous Squamous Cell", "Adjuvant"): "Cutaneous Squamous Cell Carcinoma",
    ("Head, Neck and Endocrine", "Cutaneous Squamous Cell", "Advanced or Metastatic"): "Cutaneous Squamous Cell Carcinoma",
    ("Head, Neck and Endocrine", "Cutaneous Squamous Cell", "Primary Tumor only"): "Cutaneous Squamous Cell Carcinoma",
    ("Head, Neck and Endocrine", "Cutaneous Squamous Cell", ""): "Cutaneous Squamous Cell Carcinoma",
    ("Head, Neck and Endocrine", "Thyroid", "Anaplastic"): "Anaplastic Thyroid Cancer",
    ("Head, Neck and Endocrine", "Thyroid", "Differentiated"): "Thyroid",
    ("Head, Neck and Endocrine", "Thyroid", ""): "Thyroid",
    ("Head, Neck and Endocrine", "Salivary Gland", "All"): "Salivary Carcinoma",
    ("Head, Neck and Endocrine", "Salivary Gland", "MET"): "Salivary Carcinoma",
    ("Head, Neck and Endocrine", "Endocrine-Other", "All"): "Thyroid",
    ("Head, Neck and Endocrine", "", ""): "Head and Neck",
    ("Hematological Malignancies", "Leukemia", "AML"): "Acute Myeloid Leukemia",
    ("Hematological Malignancies", "Lymphoma B-cell", "CLL/SLL"): "Chronic Lymphocytic Leukemia/Small Lymphocytic Lymphoma",
    ("Hematological Malignancies", "Lymphoma B-cell", "Follicular"): "Follicular Lymphoma",
    ("Hematological Malignancies", "Lymphoma B-cell", "Mantle Cell"): "Mantle Cell Lymphoma",
    ("Hematological Malignancies", "Lymphoma B-cell", "Marginal Zone"): "Marginal Zone Lymphoma",
    ("Hematological Malignancies", "Lymphoma B-cell", "Waldenstrom"): "Waldenstrom Macroglobulinemia",
    ("Hematological Malignancies", "Lymphoma B-cell", ""): None,
    ("Hematological Malignancies", "Lymphoma T-cell", "Relapsed / Refractory"): None,
    ("Hematological Malignancies", "Lymphoma T-cell", ""): None,
    ("Hematological Malignancies", "MPNs", "ET"): "Essential Thrombocythemia",
    ("Hematological Malignancies", "MPNs", "Myelofibrosis"): "Primary Myelofibrosis",
    ("Hematological Malignancies", "MPNs", "PV"): "Polycythemia Vera",
    ("Hematological Malignancies", "MPNs", ""): "Myeloproliferative Neoplasms",
    ("Hematological Malignancies", "Multiple Myeloma", "Multiple Myeloma"): "Plasma Cell Myeloma",
    ("Hematological Malignancies", "Multiple Myeloma", "Amyloid"): "Plasma Cell Myeloma",
    ("Hematological Malignancies", "Multiple Myeloma", ""): "Plasma Cell Myeloma",
    ("Hematological Malignancies", "", ""): None,
    ("Childhood Cancers", "Leukemia and Lymphoma", "ALL"): "B-Lymphoblastic Leukemia/Lymphoma",
    ("Childhood Cancers", "Leukemia and Lymphoma", "AML"): "Acute Myeloid Leukemia",
    ("Childhood Cancers", "Leukemia and Lymphoma", "Lymphoma"): None,
    ("Childhood Cancers", "Leukemia and Lymphoma", "Biology and Translational"): None,
    ("Childhood Cancers", "Leukemia and Lymphoma", "Cancer Control and Supportive Care"): None,
    ("Childhood Cancers", "Leukemia and Lymphoma", ""): None,
    ("Childhood Cancers", "Solid Tumor", "CNS"): "CNS/Brain",
    ("Childhood Cancers", "Solid Tumor", "Germ Cell"): None,
    ("Childhood Cancers", "Solid Tumor", "Hepatoblastoma/HCC"): "Liver",
    ("Childhood Cancers", "Solid Tumor", "RCC/Wilm's Tumor"): "Wilms' Tumor",
    ("Childhood Cancers", "Solid Tumor", "Sarcoma"): "Sarcoma, NOS",
    ("Childhood Cancers", "Solid Tumor", "Biology and Translational"): None,
    ("Childhood Cancers", "Solid Tumor", "Cancer Control and Supportive Care"): None,
    ("Childhood Cancers", "Solid Tumor", ""): None,
    ("Childhood Cancers", "Phase 1", ""): None,
    ("Childhood Cancers", "", ""): None,
    ("Cutaneous", "Cutaneous Melanoma", "Advanced"): "Melanoma",
    ("Cutaneous", "Cutaneous Melanoma", "Primary Tumor only"): "Melanoma",
    ("Cutaneous", "Cutaneous Melanoma", ""): "Melanoma",
    ("Cutaneous", "", ""): "Skin",
    ("Neurologic", "Gliomas", ""): "Diffuse Glioma",
    ("Neurologic", "Brain and Spine Metastases", ""): None,
    ("Neurologic", "Other", ""): "CNS/Brain",
    ("Neurologic", "", ""): "CNS/Brain",
    ("Connective Tissue", "Bone", "Metastatic"): "Bone",
    ("Connective Tissue", "Bone", ""): "Bone",
    ("Connective Tissue", "Soft Tissue", "Localized"): "Soft Tissue",
    ("Connective Tissue", "Soft Tissue", "Metastatic"): "Soft Tissue",
    ("Connective Tissue", "", ""): "Sarcoma, NOS",
    ("Bone Marrow Transplant", "Malignancy", "Leukemia"): None,
    ("Bone Marrow Transplant", "Malignancy", "Lymphoma"): None,
    ("Bone Marrow Transplant", "Malignancy", "Myeloma"): "Plasma Cell Myeloma",
    ("Bone Marrow Transplant", "Malignancy", ""): None,
    ("Bone Marrow Transplant", "", ""): None,
    ("Cancer Control and Prevention", "", ""): None,
    ("Multi-tumor Experimental Therapeutics", "", ""): None,
}

#: condition keyword: diagnosis, in order of precedence; None: a keyword that ends the search without a diagnosis
CONDITION_KEYWORDS = [
    ("acute myeloid leukemia", "Acute Myeloid Leukemia"),
    ("acute lymphoblastic leukemia", "B-Lymphoblastic Leukemia/Lymphoma"),
    ("b-all", "B-Lymphoblastic Leukemia/Lymphoma"),
    ("b all", "B-Lymphoblastic Leukemia/Lymphoma"),
    ("t-all", "T-Lymphoblastic Leukemia/Lymphoma"),
    ("chronic lymphocytic leukemia", "Chronic Lymphocytic Leukemia/Small Lymphocytic Lymphoma"),
    ("cll", "Chronic Lymphocytic Leukemia/Small Lymphocytic Lymphoma"),
    ("follicular lymphoma", "Follicular Lymphoma"),
    ("mantle cell lymphoma", "Mantle Cell Lymphoma"),
    ("marginal zone lymphoma", "Marginal Zone Lymphoma"),
    ("waldenstrom", "Waldenstrom Macroglobulinemia"),
    ("diffuse large b-cell lymphoma", "Diffuse Large B-Cell Lymphoma, NOS"),
    ("dlbcl", "Diffuse Large B-Cell Lymphoma, NOS"),
    ("hodgkin lymphoma", "Hodgkin Lymphoma"),
    ("t-cell lymphoma", None),
    ("multiple myeloma", "Plasma Cell Myeloma"),
    ("myelofibrosis", "Primary Myelofibrosis"),
    ("polycythemia vera", "Polycythemia Vera"),
    ("essential thrombocythemia", "Essential Thrombocythemia"),
    ("myeloproliferative", "Myeloproliferative Neoplasms"),
    ("leukemia", None),
    ("lymphoma", None),
    ("myeloma", "Plasma Cell Myeloma"),
    ("non-small cell lung", "Non-Small Cell Lung Cancer"),
    ("nsclc", "Non-Small Cell Lung Cancer"),
    ("small cell lung", "Small Cell Lung Cancer"),
    ("sclc", "Small Cell Lung Cancer"),
    ("lung cancer", "Lung"),
    ("breast cancer", "Breast"),
    ("breast", "Breast"),
    ("colorectal", "Colorectal Adenocarcinoma"),
    ("colon cancer", "Colorectal Adenocarcinoma"),
    ("rectal cancer", "Colorectal Adenocarcinoma"),
    ("pancreatic", "Pancreatic Adenocarcinoma"),
    ("hepatocellular", "Hepatocellular Carcinoma"),
    ("cholangiocarcinoma", "Intrahepatic Cholangiocarcinoma"),
    ("biliary", "Biliary Tract"),
    ("gastric", "Esophagogastric Adenocarcinoma"),
    ("esophageal", "Esophagogastric Adenocarcinoma"),
    ("gastroesophageal", "Esophagogastric Adenocarcinoma"),
    ("prostate", "Prostate Adenocarcinoma"),
    ("bladder", "Bladder Urothelial Carcinoma"),
    ("urothelial", "Bladder Urothelial Carcinoma"),
    ("renal cell carcinoma", "Renal Cell Carcinoma"),
    ("renal cancer", "Renal Cell Carcinoma"),
    ("kidney cancer", "Renal Cell Carcinoma"),
    ("ovarian", "Ovarian Epithelial Tumor"),
    ("endometrial", "Endometrial Carcinoma"),
    ("cervical", None),
    ("melanoma", "Melanoma"),
    ("glioblastoma", "Diffuse Glioma"),
    ("glioma", "Diffuse Glioma"),
    ("meningioma", "Meningioma"),
    ("germ cell", None),
    ("thyroid", "Thyroid"),
    ("head and neck", "Head and Neck Squamous Cell Carcinoma"),
    ("squamous cell carcinoma of the head", "Head and Neck Squamous Cell Carcinoma"),
    ("nasopharyngeal", "Head and Neck Squamous Cell Carcinoma"),
    ("oropharyngeal", "Head and Neck Squamous Cell Carcinoma"),
    ("salivary gland", "Salivary Carcinoma"),
    ("soft tissue sarcoma", "Soft Tissue"),
    ("sarcoma", "Sarcoma, NOS"),
    ("osteosarcoma", "Osteosarcoma"),
    ("ewing sarcoma", "Ewing Sarcoma"),
    ("rhabdomyosarcoma", "Rhabdomyosarcoma"),
    ("wilms", "Wilms' Tumor"),
    ("hepatoblastoma", "Hepatoblastoma"),
    ("neuroblastoma", "Neuroblastoma"),
    ("medulloblastoma", "Medulloblastoma"),
    ("neuroendocrine", "Gastrointestinal Neuroendocrine Tumors"),
]

#: common name: name in the vocabulary; None: a name to drop
NAME_CORRECTIONS = {
    "Multiple Myeloma": "Plasma Cell Myeloma",
    "Glioblastoma Multiforme": "Diffuse Glioma",
    "Glioma": "Diffuse Glioma",
    "Glioblastoma": "Diffuse Glioma",
    "Colorectal Cancer": "Colorectal Adenocarcinoma",
    "Colon Cancer": "Colorectal Adenocarcinoma",
    "Rectal Cancer": "Colorectal Adenocarcinoma",
    "Germ Cell Tumor": None,
    "Leukemia": None,
    "Lymphoma": None,
    "B-Cell Lymphoma": None,
    "T-Cell Lymphoma": None,
    "Biliary Tract Cancer": "Biliary Tract",
    "Esophagogastric Cancer": "Esophagogastric Adenocarcinoma",
    "Gastric Cancer": "Esophagogastric Adenocarcinoma",
    "Gastrointestinal Cancer": None,
    "Gastrointestinal Neuroendocrine Tumor": "Gastrointestinal Neuroendocrine Tumors",
    "Gynecologic Cancer": None,
    "Genitourinary Cancer": None,
    "Hematologic Malignancy": None,
    "Head and Neck Cancer": "Head and Neck",
    "Salivary Gland Cancer": "Salivary Carcinoma",
    "Thyroid Cancer": "Thyroid",
    "Differentiated Thyroid Cancer": "Thyroid",
    "Bone Cancer": "Bone",
    "Soft Tissue Sarcoma": "Soft Tissue",
    "Sarcoma": "Sarcoma, NOS",
    "CNS Cancer": "CNS/Brain",
    "Skin Cancer": "Skin",
    "Cervical Cancer": None,
    "Waldenstrom Macroglobulinemia/Lymphoplasmacytic Lymphoma": "Waldenstrom Macroglobulinemia",
    "Diffuse Large B-Cell Lymphoma": "Diffuse Large B-Cell Lymphoma, NOS",
    "Myeloproliferative Neoplasm": "Myeloproliferative Neoplasms",
    "Wilms Tumor": "Wilms' Tumor",
    "Non-Seminoma Malignant Germ Cell Tumor": "Non-Seminomatous Germ Cell Tumor",
    "Seminoma Malignant Germ Cell Tumor": "Seminoma",
    "Ovarian Immature Teratoma": "Immature Teratoma",
    "Pure Immature Teratoma": "Immature Teratoma",
    "Pure Mature Teratoma": "Mature Teratoma",
    "Pure Dysgerminoma": "Dysgerminoma",
    "Extragonadal Germ Cell Tumor": "Extra Gonadal Germ Cell Tumor",
    "Primary Central Nervous System Germ Cell Tumor": "Germ Cell Tumor, Brain",
    "Ovarian": "Ovarian Germ Cell Tumor",
    "Testicular": None,
    "Spermatocytic Seminoma": None,
    "Relapsed Acute Lymphoblastic Leukemia": "B-Lymphoblastic Leukemia/Lymphoma",
    "Atrial Fibrillation/Flutter": None,
    "Bone Marrow Failure Syndrome": None,
    "Bowel Obstruction": None,
    "Chronic Inflammatory Bowel Disease": None,
    "L2": None,
}
