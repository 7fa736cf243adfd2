"""Payment-outcome classification and customer segmentation on MLlib."""
