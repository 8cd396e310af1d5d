"""Sample records: stand-ins for provider downloads, used to try out the stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperlake import schema

# --- Fixed values: sample records by source ---
SAMPLE_RECORDS: dict[str, list[dict[str, str | None]]] = {
    "arxiv": [
        {
            "title": "Advanced Machine Learning Techniques for Natural Language Processing",
            "authors": "John Doe; Jane Smith; Bob Wilson",
            "abstract": "This paper presents novel approaches to NLP using deep learning...",
            "publication_date": "2024-01-15",
            "journal": "arXiv",
            "doi": None,
            "keywords": "machine learning; natural language processing; deep learning",
            "pdf_url": "https://arxiv.org/pdf/2401.12345.pdf",
            "source": "arxiv",
        },
        {
            "title": "Efficient Computer Vision Models for Real-time Applications",
            "authors": "Alice Johnson; Charlie Brown",
            "abstract": "We propose efficient architectures for real-time computer vision...",
            "publication_date": "2024-01-14",
            "journal": "arXiv",
            "doi": None,
            "keywords": "computer vision; real-time; efficiency",
            "pdf_url": "https://arxiv.org/pdf/2401.12346.pdf",
            "source": "arxiv",
        },
    ],
    "pubmed": [
        {
            "title": "Machine Learning Applications in Healthcare: A Comprehensive Review",
            "authors": "Dr. Sarah Wilson; Dr. Michael Chen",
            "abstract": "This review examines the current state of ML in healthcare...",
            "publication_date": "2024-01-10",
            "journal": "Nature Medicine",
            "doi": "10.1038/s41591-024-01234-5",
            "keywords": "machine learning; healthcare; medical applications",
            "pdf_url": "https://example.com/paper.pdf",
            "source": "pubmed",
        },
    ],
}


def sample_records(spark: SparkSession, source: str) -> DataFrame:
    """The sample records of one source as raw records."""
    raw = schema.raw_schema()
    rows = [tuple(record.get(f.name) for f in raw) for record in SAMPLE_RECORDS[source]]
    return spark.createDataFrame(rows, raw)
