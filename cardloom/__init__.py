"""cardloom: card-transaction features, feature selection and models as Spark DataFrame operators."""
