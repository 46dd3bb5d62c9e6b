"""Column functions shared by the plans. All are JVM-side expressions; there are no UDFs."""
